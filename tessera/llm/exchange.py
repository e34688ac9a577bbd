"""Which values of a column occur more than once: a Golomb-coded exchange, and a filter from its result."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import golomb
from tessera.llm.common import release, written

FINGERPRINT_BITS = 48
PER_OWNER = 1_000_000  # fingerprints that one owner decodes at once, about
PER_MESSAGE = 1_000_000  # fingerprints that a sender holds before it sends
FILTER_BITS = 1 << 23  # of the filter of suspects: at most 131,072 rows of 64 bits are broadcast

_MESSAGE = "owner int, sender string, n long, k int, code binary, twice binary"


def _messages(owners: int, bits: int):
    """Sender: sorted distinct fingerprints of its rows, coded for each owner's range."""
    width = -(-(1 << bits) // owners)

    def send(part: int, seq: int, held: list[np.ndarray]) -> pd.DataFrame:
        values, times = np.unique(np.concatenate(held).astype(np.uint64), return_counts=True)
        cuts = np.searchsorted(values, np.arange(owners + 1, dtype=np.uint64) * np.uint64(width))
        out = []
        for o in range(owners):
            own = values[cuts[o]: cuts[o + 1]]
            if len(own):
                k = golomb.rice_parameter(width, len(own))
                out.append((o, f"{part}-{seq}", len(own), k, golomb.encode(own, o * width, k),
                            np.packbits(times[cuts[o]: cuts[o + 1]] > 1).tobytes()))
        return pd.DataFrame(out, columns=["owner", "sender", "n", "k", "code", "twice"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq, held, n = TaskContext.get().partitionId(), 0, [], 0
        for pdf in batches:
            held.append(pdf["fp"].to_numpy())
            n += len(pdf)
            if n >= PER_MESSAGE:
                yield send(part, seq, held)
                seq, held, n = seq + 1, [], 0
        if n:
            yield send(part, seq, held)

    return run


def _bitmaps(owners: int, bits: int):
    """Owner: for each sender, which of its fingerprints somebody else (or itself, twice) has too."""
    width = -(-(1 << bits) // owners)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        low = int(pdf["owner"].iat[0]) * width
        sent = [golomb.decode(c, n, low, k) for c, n, k in zip(pdf["code"], pdf["n"], pdf["k"])]
        twice = [np.unpackbits(np.frombuffer(t, np.uint8))[:n].astype(bool) for t, n in zip(pdf["twice"], pdf["n"])]
        values, times = np.unique(np.concatenate(sent), return_counts=True)
        times[np.searchsorted(values, np.concatenate([v[t] for v, t in zip(sent, twice)]))] = 2
        maps = [np.packbits(times[np.searchsorted(values, v)] > 1).tobytes() for v in sent]
        return pd.DataFrame({"owner": pdf["owner"], "sender": pdf["sender"], "bitmap": maps})

    return run


def _suspects(owners: int, bits: int):
    """Sender again: its fingerprints whose bit is set."""
    width = -(-(1 << bits) // owners)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for o, n, k, code, bitmap in zip(pdf["owner"], pdf["n"], pdf["k"], pdf["code"], pdf["bitmap"]):
                own = golomb.decode(code, n, int(o) * width, k)
                hit = np.unpackbits(np.frombuffer(bitmap, np.uint8))[:n].astype(bool)
                yield pd.DataFrame({"fp": own[hit].astype(np.int64)})

    return run


def repeated_fingerprints(fps: DataFrame, total: int, bits: int = FINGERPRINT_BITS,
                          per_owner: int = PER_OWNER) -> DataFrame:
    """The values (column fp, each once) that occur more than once in ``fps``, of ``total`` rows.

    Values are whole numbers of ``bits`` bits. Every partition codes its
    sorted distinct values for the owners of their ranges; a value that it
    has twice is marked, so one that a third of all rows share is one number
    per partition. Owners answer with one bit per number. The number of
    owners grows with the rows. Messages and bitmaps are matched by (owner,
    sender); the messages are written to the shared folder first, so that
    both sides mean the same ones.
    """
    spark = fps.sparkSession
    owners = max(1, math.ceil(total / per_owner), min(spark.sparkContext.defaultParallelism * 2, total))
    sent = written(spark, fps.select("fp").mapInPandas(_messages(owners, bits), _MESSAGE))
    bitmaps = sent.groupBy("owner").applyInPandas(_bitmaps(owners, bits), "owner int, sender string, bitmap binary")
    found = written(spark, sent.join(bitmaps, ["owner", "sender"]).mapInPandas(_suspects(owners, bits), "fp long")
                    .distinct())
    release(sent)
    return found


def mark_suspects(rows: DataFrame, suspects: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``rows`` (with column fp) and a boolean ``suspect``, false only if fp is none of ``suspects``.

    The suspects set bits of a filter of fixed size, which is broadcast: at
    most ``filter_bits`` / 64 rows of two numbers. Rows that it lets through
    by chance cost a shuffle, not a wrong result, so it needs no other form
    for larger data; give it more bits there.
    """
    slot = F.pmod(F.xxhash64("fp"), F.lit(filter_bits))
    words = (suspects.select(slot.alias("s"))
             .groupBy((F.shiftright("s", 6)).alias("f_word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("f_bits")))
    hit = F.coalesce(F.expr("shiftrightunsigned(f_bits, cast(f_slot & 63 as int)) & 1"), F.lit(0)) == 1
    return (rows.withColumn("f_slot", slot).withColumn("f_word", F.shiftright("f_slot", 6))
            .join(F.broadcast(words), "f_word", "left").withColumn("suspect", hit)
            .drop("f_slot", "f_word", "f_bits"))
