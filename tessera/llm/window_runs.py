"""Runs of windows of all texts, which of them may repeat, and the way back from runs to texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import windows
from tessera.llm.common import _BYTE, release, row_ranges, text_buffer, text_or_empty, word_hashes, written
from tessera.llm.exchange import mark_suspects, repeated_fingerprints

CHUNK = 1 << 19  # bytes that are looked at together (some 130 bytes of arrays for each)
FILTER_BITS = 1 << 24  # of the filters that are broadcast: at most 262,144 rows of 64 bits

# (data, offsets, window length) -> (first row, place of the first symbol in that row, symbols, row bounds)
Symbols = Callable[[np.ndarray, np.ndarray, int], Iterator[tuple[int, int, np.ndarray, np.ndarray]]]


def byte_symbols(data: np.ndarray, offsets: np.ndarray, length: int):
    """Chunks of rows as bytes; a very long row comes in slices that overlap by a window."""
    for a, b in row_ranges(offsets, CHUNK):
        lo, hi = int(offsets[a]), int(offsets[b])
        step = CHUNK if hi - lo > 2 * CHUNK else max(hi - lo, 1)
        for s in range(lo, max(hi - length + 1, lo + 1), step):
            e = min(s + step + length - 1, hi)
            yield a, s - lo, _BYTE[data[s:e]], np.clip(offsets[a:b + 1], s, e) - s


def word_symbols(data: np.ndarray, offsets: np.ndarray, length: int):
    """Chunks of rows as word hashes."""
    for a, b in row_ranges(offsets, CHUNK):
        hashes, _, _, bounds = word_hashes(data, offsets[a:b + 1])
        yield a, 0, hashes, bounds


def keyed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash and text; the first two name a row (but for rows alike in id and text)."""
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def window_runs(rows: DataFrame, symbols: Symbols, length: int, seed: int) -> DataFrame:
    """doc_id, text_hash, start, n_windows, value (minimizer) and content (hash) of all windows of ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, skip, own, bounds in symbols(*text_buffer(batch["text"]), length):
                row, start, n, value, content = windows.runs(own, bounds, length, seed)
                at = pa.array(row + a)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(at), batch["text_hash"].take(at), pa.array(start + skip, pa.int64()),
                     pa.array(n.astype(np.int32)), pa.array(value.view(np.int64)), pa.array(content.view(np.int64))],
                    names=["doc_id", "text_hash", "start", "n_windows", "value", "content"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "text_hash", "text").mapInArrow(
        run, f"doc_id {kind}, text_hash long, start long, n_windows int, value long, content long")


def shared_runs(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Runs whose minimizer may occur twice, and one row for each different run among them.

    The second has value, content, n_windows, n (how often the run occurs),
    at (its first place: by doc_id, nulls last, then text_hash and start) and
    different (the number of different runs of its value). Runs are counted
    within tasks before they are shuffled.
    """
    spark = runs.sparkSession
    runs = written(spark, runs)
    total = runs.select(F.count(F.lit(1))).first()[0]
    fp = F.shiftrightunsigned("value", 16)
    suspects = repeated_fingerprints(runs.select(fp.alias("fp")), total)
    found = written(spark, mark_suspects(runs.withColumn("fp", fp), suspects, FILTER_BITS).where("suspect")
                    .drop("fp", "suspect"))
    release(runs)
    content = (found.groupBy("value", "content", "n_windows")
               .agg(F.count(F.lit(1)).alias("n"), F.min(place("start")).alias("at")))
    by_value = content.groupBy("value").agg(F.count(F.lit(1)).alias("different"))
    return found, written(spark, content.join(by_value, "value"))


def place(start: str):
    """Order of places in the corpus: id (nulls last), text, start."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("text_hash"),
                    F.col(start).alias("start"))


def _marked(rows: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    key = F.xxhash64("doc_id", "text_hash")
    marked = mark_suspects(rows.withColumn("fp", key), wanted.select(key.alias("fp")), FILTER_BITS).drop("fp")
    return marked, wanted.withColumnsRenamed({"doc_id": "w_id", "text_hash": "w_hash"})


_SAME_ROW = "doc_id <=> w_id and text_hash = w_hash"


def with_text(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rows`` joined with ``wanted`` by doc_id and text_hash; few other texts are shuffled."""
    marked, right = _marked(rows, written(rows.sparkSession, wanted))
    return marked.where("suspect").drop("suspect").join(right, F.expr(_SAME_ROW)).drop("w_id", "w_hash")


def split_by_spans(rows: DataFrame, spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that may have spans (doc_id, text, spans: perhaps empty), and the others, which aren't shuffled."""
    marked, right = _marked(rows, spans)
    none = F.array().cast(spans.schema["spans"].dataType)
    cut = (marked.where("suspect").join(right, F.expr(_SAME_ROW), "left")
           .select("doc_id", "text", F.coalesce("spans", none).alias("spans")))
    return cut, marked.where(~F.col("suspect")).drop("suspect")
