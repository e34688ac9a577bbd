"""SimHash near-deduplication: fingerprints of word shingles, joined on a grid of bit counts."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import load, text_or_empty, written
from tessera.llm.components import components

SHINGLE = 3  # words
MAX_BITS = 3  # at which fingerprints are linked
SEED = 42
SLICE = 1 << 16  # shingles whose bits are counted together
CELL_CHUNK = 4096  # fingerprints of one grid cell that are compared in one block


def fingerprint(raw: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of a text's word shingles, repeats included; 0 without words."""
    words = raw.lower().split()  # of bytes: A-Z only, and exactly the six white-space bytes
    if not words:
        return 0
    line = b" ".join(words)
    n = max(len(words) - shingle + 1, 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:n - 1])).tolist()
    stops = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(line[a:b], seed) for a, b in zip(starts, stops)], np.uint64, n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, SLICE):
        bits = np.unpackbits(hashes[i:i + SLICE].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist()))


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash (64 bits, tells rows of one id apart) and fp (signed 64 bits) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_buffer().to_pybytes(), shingle) for t in batch["text"].cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_hash"], pa.array(np.array(fps, dtype=np.uint64).view(np.int64))],
                names=["doc_id", "text_hash", "fp"])

    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, fp long")


# ---- the grid join ------------------------------------------------------------------

def segment_counts(fp: Column) -> Column:
    """Bit counts of the 32 two-bit segments of a fingerprint, packed two bits each."""
    odd = F.lit(0x5555555555555555)
    high, low = F.shiftrightunsigned(fp, 1).bitwiseAND(odd), fp.bitwiseAND(odd)
    return high.bitwiseXOR(low).bitwiseOR(F.shiftleft(high.bitwiseAND(low), 1))


def grid_masks(max_bits: int) -> list[int]:
    """Masks over the packed counts, one per grid.

    The 32 counts are dealt into ``max_bits + 2`` axes. Fingerprints within
    ``max_bits`` bits have count vectors within Manhattan distance
    ``max_bits``, so at least two axes agree in every count: a grid for each
    pair of axes, with cells of width one, brings all such pairs together.
    """
    axes = np.array_split(np.arange(32), max_bits + 2)
    field = [sum(3 << (2 * int(s)) for s in axis) for axis in axes]
    return [a | b for a, b in itertools.combinations(field, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


_SEGMENTS = np.arange(0, 64, 2, dtype=np.uint64)


def _counts(fp: np.ndarray) -> np.ndarray:
    """(n, 32) bit counts of the two-bit segments."""
    pairs = (fp[:, None] >> _SEGMENTS) & np.uint64(3)
    return ((pairs >> np.uint64(1)) + (pairs & np.uint64(1))).astype(np.int8)


def _near(one: np.ndarray, other: np.ndarray, max_bits: int) -> np.ndarray:
    """Which rows of two arrays of fingerprints are linked: the Manhattan bound first, then exactly."""
    maybe = np.flatnonzero(np.abs(_counts(one) - _counts(other)).sum(axis=1) <= max_bits)
    return maybe[np.bitwise_count(one[maybe] ^ other[maybe]) <= max_bits]


def _cell_links(fp: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect what is connected within one large cell: at most one per fingerprint.

    Walks from fingerprint to fingerprint, each time comparing with those
    not reached yet, so no pair is written twice and a group of n copies
    gives n - 1 links, not n squared.
    """
    left, out = np.unique(fp), []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            hits = _near(np.full(len(left), at), left, max_bits)
            if len(hits):
                out += [(int(at), int(x)) for x in left[hits]]
                queue += list(left[hits])
                left = np.delete(left, hits)
    return out


def _verify(max_bits: int):
    """Rows sorted by (grid, cell, block): links within each cell; a run may span batches."""

    def links(key: np.ndarray, fp: np.ndarray) -> pd.DataFrame:
        cuts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        sizes = np.diff(np.append(cuts, len(key)))
        out_a, out_b = [], []
        small = sizes <= 8
        for d in range(1, 8):  # all small cells together, by distance in the run
            at = np.concatenate([cuts[small & (sizes > d + s)] + s for s in range(8 - d)])
            if len(at):
                hit = at[_near(fp[at], fp[at + d], max_bits)]
                out_a.append(fp[hit])
                out_b.append(fp[hit + d])
        for c, n in zip(cuts[~small], sizes[~small]):
            for a, b in _cell_links(fp[c:c + n], max_bits):
                out_a.append(np.array([a], np.uint64))
                out_b.append(np.array([b], np.uint64))
        a = np.concatenate(out_a) if out_a else np.empty(0, np.uint64)
        b = np.concatenate(out_b) if out_b else np.empty(0, np.uint64)
        return pd.DataFrame({"fp_a": a.view(np.int64), "fp_b": b.view(np.int64)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        for pdf in batches:
            key = np.concatenate([key, pdf["run"].to_numpy(np.int64)])
            fp = np.concatenate([fp, pdf["fp"].to_numpy(np.int64).view(np.uint64)])
            last = int(np.argmax(key == key[-1])) if len(key) else 0  # the open run waits
            if last:
                yield links(key[:last], fp[:last])
                key, fp = key[last:], fp[last:]
        if len(key):
            yield links(key, fp)

    return run


def fingerprint_links(distinct: DataFrame, max_bits: int = MAX_BITS, chunk: int = CELL_CHUNK) -> DataFrame:
    """(fp_a, fp_b) pairs within ``max_bits`` bits that connect all such pairs of ``distinct`` (fp).

    Cells of one fingerprint are dropped before the join. A cell of more than
    ``chunk`` is dealt into chunks by hash and compared chunk by chunk in
    separate tasks, each row going to as many blocks as there are chunks.
    """
    counts = segment_counts(F.col("fp"))
    grids = F.array(*[F.struct(F.lit(i).alias("grid"), counts.bitwiseAND(F.lit(_signed(m))).alias("cell"))
                      for i, m in enumerate(grid_masks(max_bits))])
    placed = distinct.select("fp", F.explode(grids).alias("g")).select("fp", "g.grid", "g.cell")
    cells = placed.groupBy("grid", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    full = placed.join(cells, ["grid", "cell"]).withColumn("chunks", F.ceil(F.col("n") / F.lit(chunk)).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    blocks = full.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    keyed = blocks.select("fp", F.xxhash64("grid", "cell", F.least("own", "other"), F.greatest("own", "other"))
                          .alias("run"))
    # runs that meet by chance in one hash are verified together: more work, the same links
    return (keyed.repartition("run").sortWithinPartitions("run", "fp")
            .mapInPandas(_verify(max_bits), "fp_a long, fp_b long"))


def near_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, text_hash, fingerprint (16 hex digits) and component_id of each row.

    Rows of one fingerprint are one class, however many they are; only
    distinct fingerprints enter the grid join, and links between classes make
    the components. ``component_id`` is the smallest id reachable; ids that
    are null are not counted (null if there is no other). A null text is
    empty; texts without words have fingerprint zero and are linked like any
    other. Repeated rows each give a row; an empty table gives none.
    """
    spark = docs.sparkSession
    rows = written(spark, fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle))
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    classes = written(spark, classes)
    links = fingerprint_links(classes.select("fp"), max_bits)
    roots = components(spark, links.select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b")))
    rooted = (classes.join(roots, classes["fp"] == roots["v"], "left")
              .select("fp", F.coalesce("root", "fp").alias("root"), "least_id"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id", "root")
    return (rows.join(named, "fp")
            .select("doc_id", "text_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id", "root"))


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component, the one of the smallest id; all its columns, unchanged.

    Null ids come last; rows alike in id and text count as one. Only the
    decisions that drop rows are joined to the texts.
    """
    names = docs.columns
    groups = written(docs.sparkSession, near_groups(docs, id_col=id_col, text_col=text_col, shingle=shingle,
                                                    max_bits=max_bits))
    keys = groups.groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("text_hash"))
    first = keys.groupBy("root").agg(F.min(order).alias("first"), F.sum("n").alias("size")).where("size > 1")
    judged = keys.join(first, "root").select(
        F.col("doc_id").alias("k_id"), "text_hash", "n", (order == F.col("first")).alias("keep"))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("r_id"),
                       F.xxhash64(text_or_empty(text_col)).alias("r_hash"))
    on = F.col("r_id").eqNullSafe(F.col("k_id")) & (F.col("r_hash") == F.col("text_hash"))
    passed = rows.join(judged.where("not keep or n > 1"), on, "left_anti").select("row")
    # rows alike in id and text, of which one stays
    again = (rows.join(judged.where("keep and n > 1"), on)
             .groupBy("k_id", "text_hash").agg(F.first("row").alias("row")).select("row"))
    return passed.unionByName(again).select(*[F.col("row").getField(c).alias(c) for c in names])


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_groups(load(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")
