"""Removal of repeated word sequences by compaction of a de Bruijn graph.

Every window of 20 words is an edge, from its first 19 words to its last 19.
Windows travel in runs (see windows.py); equal runs are one node of a graph
that is compacted already where windows share a minimizer. What is left of
the nonbranching paths is compacted by joins, and source coordinates say
where each path occurs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import windows
from tessera.llm.common import load, release, row_ranges, text_buffer, word_hashes, written
from tessera.llm.exchange import mark_suspects, repeated_fingerprints
from tessera.llm.window_runs import (
    CHUNK, FILTER_BITS, keyed_rows, place, shared_runs, split_by_spans, window_runs, with_text, word_symbols,
)

LENGTH = 20  # words
SEED = 6  # words whose least hash tells where a window goes


# ---- paths ----------------------------------------------------------------------------

def _heads(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(v, head, offset) of each node of ``links`` (v, p, d: v comes d windows after p; p is v at a head).

    Pointers are doubled until all end at a head. No cycle of windows can be
    nonbranching: a row's last window of the cycle would have no successor.
    """
    while True:
        last = links
        up = links.select(F.col("v").alias("p"), F.col("p").alias("pp"), F.col("d").alias("dd"))
        moved = written(spark, links.join(up, "p").select("v", F.col("pp").alias("p"), (F.col("d") + F.col("dd"))
                                                          .alias("d"), (F.col("dd") > 0).alias("moved")))
        release(last)
        links = moved
        if moved.where("moved").limit(1).isEmpty():
            return links.select("v", F.col("p").alias("head"), F.col("d").alias("offset"))


def repeated_paths(found: DataFrame, content: DataFrame) -> DataFrame:
    """Where repeated nonbranching paths occur again: doc_id, text_hash, start, n_windows, w (first place).

    Nodes are the different runs that occur at least twice. A node's
    successor is the run that follows it wherever it occurs, if it is always
    the same; two nodes are joined if each is the other's only neighbour. So
    all nodes of a path occur equally often, and the occurrences of its head
    stand for all of them.
    """
    spark = found.sparkSession
    node = F.xxhash64("value", "content", "n_windows")
    nodes = content.where("n > 1").select("value", "content", "n_windows", "n", "at", node.alias("node"))
    occurrences = written(spark, found.join(nodes, ["value", "content", "n_windows"])
                          .select("doc_id", "text_hash", "start", "n_windows", "node", "n", "at"))
    # the run that comes next in the same text
    line = Window.partitionBy("doc_id", "text_hash").orderBy("start")
    follows = (occurrences.select("start", "n_windows", "node", "n",
                                  F.lead(F.struct("start", "node", "n")).over(line).alias("next"))
               .where(F.col("next.start") == F.col("start") + F.col("n_windows")))
    pairs = (follows.groupBy(F.col("node").alias("p"), F.col("next.node").alias("v"))
             .agg(F.count(F.lit(1)).alias("n"), F.first("n_windows").cast("long").alias("d"),
                  F.first("n").alias("p_n"), F.first("next.n").alias("v_n")))
    # a node that is always followed by the other, which always follows it
    joined = pairs.where("n = p_n and n = v_n and p <> v").select("v", "p", "d")
    every = nodes.select(F.col("node").alias("v"), "n_windows")
    links = written(spark, every.join(joined, "v", "left")
                    .select("v", F.coalesce("p", "v").alias("p"), F.coalesce("d", F.lit(0).cast("long")).alias("d")))
    heads = _heads(spark, links)
    lengths = heads.join(every, "v").groupBy("head").agg(F.max(F.col("offset") + F.col("n_windows")).alias("windows"))
    return (occurrences.where(~F.col("at").eqNullSafe(place("start")))
            .join(lengths, F.col("node") == F.col("head"))
            .select("doc_id", "text_hash", "start", F.col("windows").cast("long").alias("n_windows"),
                    F.col("at").alias("w")))


# ---- edges where runs differ -----------------------------------------------------------

def _edges(length: int):
    """The hash of each window of the wanted runs of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch["text"])
            for a, b in row_ranges(offsets, CHUNK):
                hashes, _, _, bounds = word_hashes(data, offsets[a:b + 1])
                sums = windows.prefix_sums(hashes)
                rows, places, edges = [], [], []
                for i, runs in enumerate(batch["runs"].slice(a, b - a)):
                    at = np.concatenate([np.arange(r["start"], r["start"] + r["n_windows"]) for r in runs.as_py()])
                    rows.append(np.full(len(at), a + i))
                    places.append(at)
                    edges.append(windows.range_hash(sums, at + bounds[i], at + bounds[i] + length))
                take = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(take), batch["text_hash"].take(take), pa.array(np.concatenate(places)),
                     pa.array(np.concatenate(edges).view(np.int64))], names=["doc_id", "text_hash", "start", "edge"])

    return run


def repeated_edges(rows: DataFrame, content: DataFrame, length: int) -> DataFrame:
    """Windows that occur earlier in a different run: doc_id, text_hash, start, n_windows, w.

    Only the first occurrences of runs that share their minimizer with other
    runs are looked into; neighbouring windows with one source are put
    together.
    """
    spark = rows.sparkSession
    kind = rows.schema["doc_id"].dataType.simpleString()
    wanted = (content.where("different > 1").select("at.doc_id", "at.text_hash", "at.start", "n_windows")
              .groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "n_windows")).alias("runs")))
    edges = written(spark, with_text(rows, wanted).select("doc_id", "text_hash", "text", "runs").mapInArrow(
        _edges(length), f"doc_id {kind}, text_hash long, start long, edge long"))
    fp = F.shiftrightunsigned("edge", 16)
    total = edges.select(F.count(F.lit(1))).first()[0]
    repeated = repeated_fingerprints(edges.select(fp.alias("fp")), total)
    every = edges
    edges = written(spark, mark_suspects(edges.withColumn("fp", fp), repeated, FILTER_BITS).where("suspect")
                    .drop("fp", "suspect"))
    release(every)
    first = edges.groupBy("edge").agg(F.min(place("start")).alias("w"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = (edges.join(first, "edge").where(~F.col("w").eqNullSafe(place("start")))
             .select("doc_id", "text_hash", "start", "w", (F.col("start") - F.col("w.start")).alias("shift")))
    own = ["doc_id", "text_hash", "w.doc_id", "w.text_hash", "shift"]
    line = Window.partitionBy(*own).orderBy("start")
    return (later.withColumn("island", F.col("start") - F.row_number().over(line))
            .groupBy("doc_id", "text_hash", F.col("w.no_id").alias("no_id"), F.col("w.doc_id").alias("w_doc"),
                     F.col("w.text_hash").alias("w_text"), "shift", "island")
            .agg(F.min("start").alias("start"), F.count(F.lit(1)).alias("n_windows"))
            .select("doc_id", "text_hash", "start", "n_windows",
                    F.struct("no_id", F.col("w_doc").alias("doc_id"), F.col("w_text").alias("text_hash"),
                             (F.col("start") - F.col("shift")).alias("start")).alias("w")))


# ---- verification and removal ----------------------------------------------------------

def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the words of each wanted range, joined by a space."""
    for batch in batches:
        out = []
        for doc_id, text_hash, text, ranges in zip(batch["doc_id"], batch["text_hash"],
                                                   batch["text"].cast(pa.binary()), batch["ranges"]):
            words = text.as_py().split()
            for r in ranges.as_py():
                digest = hashlib.sha256(b" ".join(words[r["start"]:r["end"]])).digest()
                out.append((doc_id.as_py(), text_hash.as_py(), r["start"], r["end"], digest))
        cols = list(zip(*out)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], batch.schema.field("doc_id").type), pa.array(cols[1], pa.int64()),
             pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.binary())],
            names=["doc_id", "text_hash", "start", "end", "digest"])


def verified(rows: DataFrame, spans: DataFrame, length: int) -> DataFrame:
    """Those ``spans`` whose words, read again from both texts, are the same as at their first place."""
    spark = rows.sparkSession
    kind = rows.schema["doc_id"].dataType.simpleString()
    stop = F.col("n_windows") + F.lit(length - 1)
    spans = written(spark, spans)
    here = spans.select("doc_id", "text_hash", "start", (F.col("start") + stop).alias("end"))
    there = spans.select("w.doc_id", "w.text_hash", "w.start", (F.col("w.start") + stop).alias("end"))
    wanted = (here.unionByName(there).distinct().groupBy("doc_id", "text_hash")
              .agg(F.collect_list(F.struct("start", "end")).alias("ranges")))
    digests = written(spark, with_text(rows, wanted).select("doc_id", "text_hash", "text", "ranges").mapInArrow(
        _digests, f"doc_id {kind}, text_hash long, start long, end long, digest binary").distinct())
    a = digests.toDF("a_id", "a_hash", "a_start", "a_end", "a_digest")
    b = digests.toDF("b_id", "b_hash", "b_start", "b_end", "b_digest")
    return (spans.withColumn("stop", stop)
            .join(a, F.expr("doc_id <=> a_id and text_hash = a_hash and start = a_start and start + stop = a_end"))
            .join(b, F.expr("w.doc_id <=> b_id and w.text_hash = b_hash and w.start = b_start "
                            "and w.start + stop = b_end and a_digest = b_digest"))
            .select("doc_id", "text_hash", "start", "n_windows"))


def _removal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the words of their spans."""
    for batch in batches:
        spans, n_words, removed, kept = batch["spans"], [], [], []
        flat, bounds = spans.flatten(), np.concatenate(([0], np.cumsum(spans.value_lengths().to_numpy())))
        start, end = flat.field("start").to_numpy(), flat.field("end").to_numpy()
        for i, text in enumerate(batch["text"].cast(pa.binary())):
            words = text.as_py().split()
            gone, _ = windows.covered(start[bounds[i]:bounds[i + 1]], end[bounds[i]:bounds[i + 1]], len(words))
            n_words.append(len(words))
            removed.append(int(gone.sum()))
            kept.append(b" ".join([words[j] for j in np.flatnonzero(~gone)]))
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])


def remove_repeated_words(docs: DataFrame, length: int = LENGTH, seed: int = SEED, *, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words left, joined by a space) of each row.

    A word goes if it lies in a window of ``length`` words that also starts
    earlier: in a row of a smaller id, or before in the same row. Null ids
    are larger than any other. Rows of one id and different texts are ordered
    by a hash of the text; rows alike in both are one. A null text has no
    words; an empty table gives no rows; other columns are ignored.
    """
    rows = keyed_rows(docs, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    found, content = shared_runs(window_runs(rows, word_symbols, length, seed))
    spans = repeated_paths(found, content).unionByName(repeated_edges(rows, content, length))
    gone = written(docs.sparkSession, verified(rows, spans, length)
                   .groupBy("doc_id", "text_hash")
                   .agg(F.collect_list(F.struct("start", (F.col("start") + F.col("n_windows") + F.lit(length - 1))
                                                .alias("end"))).alias("spans")))
    cut, rest = split_by_spans(rows, gone)
    schema = f"doc_id {kind}, n_words long, n_removed long, kept string"
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    whole = rest.select("doc_id", "text", none.alias("spans"))
    return cut.mapInArrow(_removal, schema).unionByName(whole.mapInArrow(_removal, schema))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without word sequences of 20 that occur earlier."""
    kept = remove_repeated_words(load(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = """
with tokens as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
starts as (
  select doc_id, w, unnest(range(1, greatest(len(w) - 18, 1))) as i from tokens),
grams as (select doc_id, i, array_to_string(w[i:i + 19], ' ') as g from starts),
later as (
  select doc_id, i from (
    select doc_id, i, row_number() over (partition by g order by doc_id, i) as k from grams) where k > 1),
gone as (select distinct doc_id, i + j as p from later, (select unnest(range(20)) as j)),
words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from tokens),
kept as (
  select words.doc_id, string_agg(word, ' ' order by words.p) as t, count(*) as n
  from words left join gone on words.doc_id = gone.doc_id and words.p = gone.p
  where gone.p is null group by words.doc_id)
select t.doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
       sha256(coalesce(kept.t, '')) as kept_sha256
from tokens t left join kept on t.doc_id = kept.doc_id
"""
