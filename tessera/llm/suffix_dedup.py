"""Removal of repeated byte strings by suffix arrays of shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import windows
from tessera.llm.common import _BYTE, load, mix64, pack_sorted, text_buffer, unpack_sorted, written
from tessera.llm.suffix_array import common_prefixes, suffix_array
from tessera.llm.window_runs import (
    byte_symbols, keyed_rows, shared_runs, split_by_spans, window_runs, with_text,
)

LENGTH = 400  # bytes of a string that counts as repeated
SEED = 64  # bytes whose least hash tells where a window goes
SHARD_BYTES = 600_000  # of segments in one suffix array, about
SPLIT_AT = 512  # different segments of one minimizer that are dealt to one shard, about


# ---- one shard ------------------------------------------------------------------------

class _Shard:
    """Groups of equal windows among the segments of one shard, from their suffix array."""

    def __init__(self, pdf: pd.DataFrame, length: int):
        pdf = pdf.sort_values(["value", "content", "n_windows"], kind="stable")
        self.rows, self.length = pdf, length
        sizes = pdf["segment"].map(len).to_numpy()
        self.text = np.frombuffer(b"".join(pdf["segment"]), dtype=np.uint8)
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        self.owner = np.repeat(np.arange(len(pdf)), sizes)
        offset = np.arange(len(self.text)) - self.starts[self.owner]
        valid = offset < pdf["n_windows"].to_numpy()[self.owner]
        sa = suffix_array(self.text)
        first = common_prefixes(self.text, sa, length) < length
        weight = np.where(valid, pdf["n"].to_numpy()[self.owner], 0)[sa]
        heads = np.flatnonzero(first)
        self.group = np.empty(len(self.text), dtype=np.int64)  # by position
        self.group[sa] = np.cumsum(first) - 1
        self.times = np.add.reduceat(weight, heads)  # occurrences of each group's string in all texts
        self.valid = valid

    def fingerprints(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Groups of windows of split segments, in the order of their 128-bit fingerprints, and these in two halves."""
        at = np.flatnonzero(self.valid & self.rows["split"].to_numpy()[self.owner])
        group, first = np.unique(self.group[at], return_index=True)
        at = at[first]
        one = windows.range_hash(windows.prefix_sums(_BYTE[self.text]), at, at + self.length)
        other = windows.range_hash(windows.prefix_sums(mix64(_BYTE[self.text] + np.uint64(1))), at, at + self.length)
        order = np.lexsort((other, one))
        return group[order], one[order], other[order]

    def repeated(self) -> pd.DataFrame:
        """value, content, n_windows and the runs (first, last window) that occur more than once."""
        hit = self.valid & (self.times[self.group] > 1)
        edge = np.diff(np.concatenate(([False], hit, [False])).astype(np.int8))
        edge_at = np.flatnonzero(edge == 1)
        last = np.flatnonzero(edge == -1) - 1
        # a run of windows never crosses segments: the last positions of each are no windows
        own = self.owner[edge_at]
        out = self.rows.iloc[own][["value", "content", "n_windows"]].copy()
        out["first"] = edge_at - self.starts[own]
        out["last"] = last - self.starts[own]
        return out


def _owner_bits(one: np.ndarray, bits: int) -> np.ndarray:
    return np.searchsorted(one, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))


def _sorted_runs(length: int, bits: int):
    """Shard: its different windows of split segments as sorted fingerprints, cut at the owners' bounds."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        _, one, other = _Shard(pdf, length).fingerprints()
        cuts = np.concatenate(([0], _owner_bits(one, bits), [len(one)]))
        out = [(int(pdf["shard"].iat[0]), o, int(b - a), pack_sorted(one[a:b]), other[a:b].tobytes())
               for o, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b]
        return pd.DataFrame(out, columns=["shard", "owner", "n", "one", "other"])

    return run


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    """Owner of a fingerprint range: for each shard, a bit for each window that another shard has too.

    Each shard's run is looked up in the merged one by binary search.
    """
    one = [unpack_sorted(x) for x in pdf["one"]]
    other = [np.frombuffer(x, dtype=np.uint64) for x in pdf["other"]]
    all_one, all_other = np.concatenate(one), np.concatenate(other)
    order = np.lexsort((all_other, all_one))
    all_one, all_other = all_one[order], all_other[order]
    new = np.ones(len(all_one), dtype=bool)
    new[1:] = (all_one[1:] != all_one[:-1]) | (all_other[1:] != all_other[:-1])
    heads = np.flatnonzero(new)
    times = np.diff(np.append(heads, len(all_one)))
    key_one, key_other = all_one[heads], all_other[heads]
    maps = []
    for a, b in zip(one, other):
        at = np.searchsorted(key_one, a)
        while True:  # halves that tie in the first 64 bits: on to the second
            behind = key_other[at] < b
            if not behind.any():
                break
            at = at + behind
        maps.append(np.packbits(times[at] > 1).tobytes())
    return pd.DataFrame({"shard": pdf["shard"], "owner": pdf["owner"], "n": pdf["n"], "bitmap": maps})


def _finish(length: int):
    """Shard: what repeats in it or, by the bits that came back, in another shard of its minimizer."""

    def run(segments: pd.DataFrame, bits: pd.DataFrame) -> pd.DataFrame:
        shard = _Shard(segments, length)
        if len(bits):
            group, _, _ = shard.fingerprints()
            bits = bits.sort_values("owner")
            hit = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8))[:n]
                                  for m, n in zip(bits["bitmap"], bits["n"])]).astype(bool)
            shard.times[group[hit]] = 2
        return shard.repeated()

    return run


def repeated_runs(segments: DataFrame, length: int = LENGTH, *, total_bytes: int, shard_bytes: int = SHARD_BYTES,
                  split_at: int = SPLIT_AT) -> DataFrame:
    """value, content, n_windows, first, last: the windows of each segment that occur more than once.

    ``segments`` has value, content, n_windows, n (how often the segment
    occurs), different (segments of its value) and segment (bytes). A value's
    segments share a shard. If there are very many, they are dealt in parts
    to several shards, whose sorted windows of such values are merged.
    """
    shards = max(1, -(-total_bytes // shard_bytes))
    bits = max(1, int(shards - 1).bit_length())
    split = F.col("different") > split_at
    part = F.pmod(F.xxhash64("content"), F.ceil(F.col("different") / F.lit(split_at)).cast("long"))
    dealt = segments.select(
        "value", "content", "n_windows", "n", "segment", split.alias("split"),
        F.pmod(F.when(split, F.xxhash64("value", part)).otherwise(F.xxhash64("value")), F.lit(shards))
        .alias("shard"))
    with_split = dealt.where("split").select("shard").distinct()
    shard_runs = dealt.join(with_split, "shard", "left_semi").groupBy("shard").applyInPandas(
        _sorted_runs(length, bits), "shard long, owner int, n long, one binary, other binary")
    bitmaps = shard_runs.groupBy("owner").applyInPandas(_merge, "shard long, owner int, n long, bitmap binary")
    return dealt.groupBy("shard").cogroup(bitmaps.groupBy("shard")).applyInPandas(
        _finish(length), "value long, content long, n_windows int, first long, last long")


# ---- all texts ------------------------------------------------------------------------

def repeated_spans(rows: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """doc_id, text_hash, spans (start, end): bytes that a repeated string covers, for rows that have any.

    ``rows`` has doc_id, text_hash and text. Windows travel as runs with one
    minimizer, and only runs whose minimizer occurs twice. Equal runs are
    counted once: they repeat as a whole. Only where different runs share a
    minimizer are their bytes cut from the texts and sorted.
    """
    found, content = shared_runs(window_runs(rows, byte_symbols, length, seed))

    mixed = content.where("different > 1")
    wanted = (mixed.select("value", "content", "n_windows", "n", "different", "at.*")
              .groupBy("doc_id", "text_hash")
              .agg(F.collect_list(F.struct("value", "content", "n_windows", "n", "different", "start")).alias("cuts")))
    cut = (with_text(rows, wanted).select("text", F.explode("cuts").alias("c"))
           .select("c.*", F.expr(f"substring(cast(text as binary), cast(c.start + 1 as int), "
                                 f"c.n_windows + {length - 1})").alias("segment")))
    total_bytes = mixed.select(F.coalesce(F.sum(F.col("n_windows") + F.lit(length)), F.lit(0))).first()[0]
    partial = repeated_runs(cut.select("value", "content", "n_windows", "n", "different", "segment"), length,
                            total_bytes=total_bytes)
    whole = content.where("n > 1").select("value", "content", "n_windows", F.lit(0).cast("long").alias("first"),
                                          (F.col("n_windows") - 1).cast("long").alias("last"))
    single = content.where("n = 1 and different > 1").select("value", "content", "n_windows")
    hits = whole.unionByName(partial.join(single, ["value", "content", "n_windows"], "left_semi"))
    return (found.join(hits, ["value", "content", "n_windows"])
            .select("doc_id", "text_hash",
                    F.struct((F.col("start") + F.col("first")).alias("start"),
                             (F.col("start") + F.col("last") + F.lit(length)).alias("end")).alias("span"))
            .groupBy("doc_id", "text_hash").agg(F.collect_list("span").alias("spans")))


def _removal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the bytes of their spans."""
    for batch in batches:
        data, offsets = text_buffer(batch["text"])
        spans = batch["spans"]
        flat, bounds = spans.flatten(), np.concatenate(([0], np.cumsum(spans.value_lengths().fill_null(0).to_numpy())))
        start, end = flat.field("start").to_numpy(), flat.field("end").to_numpy()
        kept, removed, runs = [], [], []
        for i in range(len(batch)):
            raw = data[offsets[i]:offsets[i + 1]]
            gone, n = windows.covered(start[bounds[i]:bounds[i + 1]], end[bounds[i]:bounds[i + 1]], len(raw))
            kept.append(raw[~gone].tobytes())
            removed.append(int(gone.sum()))
            runs.append(n)
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(offsets[1:] - offsets[:-1], pa.int64()), pa.array(removed, pa.int64()),
             pa.array(runs, pa.int64()), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, *, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (bytes) of each row.

    Each byte goes that lies in a string of ``length`` bytes which also
    starts anywhere else, in any row. Rows alike in id and text are copies of
    each other. A null text is empty; null ids are as good as any; an empty
    table gives no rows; other columns are ignored. What is kept need not be
    valid UTF-8.
    """
    rows = keyed_rows(docs, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    spans = written(docs.sparkSession, repeated_spans(rows, length, seed))
    cut, rest = split_by_spans(rows, spans)
    cut = (cut.mapInArrow(_removal, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary"))
    none = F.lit(0).cast("long")
    rest = rest.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), none.alias("n_removed"),
        none.alias("n_spans"), F.col("text").cast("binary").alias("kept"))
    return rest.unionByName(cut)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without byte strings of 400 that occur elsewhere."""
    kept = remove_repeats(load(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, ''))) as n
           from documents),
w as (select doc_id, i, md5_number(substr(h, 2 * i + 1, 800)) as k
      from (select doc_id, h, unnest(range(n - 399)) as i from d where n >= 400)),
hit as (select doc_id, i, i > 400 + lag(i) over (partition by doc_id order by i) as apart
        from w where k in (select k from w group by k having count(*) > 1)),
run as (select doc_id, i, sum(case when apart then 1 else 0 end) over (partition by doc_id order by i) as r from hit),
span as (select doc_id, min(i) as a, max(i) + 400 as b from run group by doc_id, r),
piece as (select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as from_b from span),
cut as (select doc_id, count(*) as n_spans, sum(b - a)::bigint as n_removed, max(b) as last_b,
               list((from_b, a) order by a) as kept from piece group by doc_id)
select d.doc_id, d.n as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(case when kept is null then h else
         array_to_string(list_transform(kept, lambda p: substr(h, 2 * p[1] + 1, 2 * (p[2] - p[1]))), '')
         || substr(h, 2 * last_b + 1) end)) as kept_sha256
from d left join cut using (doc_id)
"""
