"""Importance resampling towards a target distribution of hashed word n-grams."""

from __future__ import annotations

import hashlib
import math
import operator
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import crc
from tessera.llm.common import load, row_ranges, text_buffer, text_or_empty, written
from tessera.operators.ranks import global_rank

BUCKETS = 10_000
RUN = 2  # longest feature, in words
LEAST_WORDS = 20  # of a document that can be drawn
PERCENT = 25  # of those documents that are drawn
SEED = 7
CHUNK = 1 << 20  # bytes of text whose words are in one dictionary
LONG_WORD = 256  # bytes; a longer word goes by a short name within its chunk

# Word bytes are 0-9, a-z and all of non-ASCII characters; A-Z are lowered, any other byte is a delimiter.
_DELIMITED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
                   for c in range(256))
_SCANNED = "doc_id long, n_words long, n_features long, buckets binary"
_MARK = b"\x00"  # between rows; no delimited text holds it, nor \x01
_NAME = b"\x01"
_LONG = re.compile(rb"[^ \x00\x01]{%d,}" % (LONG_WORD + 1))


def scan(text: bytes) -> np.ndarray:
    """Payloads of the words of a delimited text in order, 0 for each row mark.

    The distinct words, bounded by delimiters, are the dictionary of an
    Aho-Corasick automaton; a word's payload is its CRC-32 (upper half) and
    its length in bytes. As every entry begins and ends with a delimiter,
    the automaton emits each word once, whole.
    """
    long_words: dict[bytes, bytes] = {}
    if len(text) > LONG_WORD:
        text = _LONG.sub(lambda m: long_words.setdefault(m[0], _NAME + b"%d" % len(long_words)), text)
    entries = {w: w for w in set(text.split())}
    entries.pop(_MARK, None)
    entries |= {name: word for word, name in long_words.items()}
    words = ahocorasick.Automaton()
    for name, word in entries.items():
        words.add_word(f" {name.decode('latin-1')} ", zlib.crc32(word) << 32 | len(word))
    words.add_word(_MARK.decode("latin-1"), 0)
    words.make_automaton()
    found = map(operator.itemgetter(1), words.iter(f" {text.decode('latin-1')} "))
    return np.fromiter(found, np.uint64)


def compose(payloads: np.ndarray, before: np.ndarray, buckets: int = BUCKETS, run: int = RUN
            ) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features that end in ``payloads``, and how many end at each of them.

    ``before`` are the last ``run`` - 1 payloads before these; 0 parts rows.
    The CRC of a longer feature is that of its parts: the shorter one, a
    space, and the next word.
    """
    whole = np.concatenate([before, payloads])
    hashes, lengths = (whole >> np.uint64(32)).astype(np.uint32), (whole & np.uint64(0xFFFFFFFF)).astype(np.int64)
    word = whole != 0
    columns, valid = [hashes % np.uint32(buckets)], [word]
    at, sums = np.flatnonzero(word), hashes[word]  # ends of the features of k words, and their CRCs
    for _ in range(1, run):
        follows = (at + 1 < len(whole)) & word[np.minimum(at + 1, len(whole) - 1)]
        at, sums = at[follows] + 1, crc.append_byte(sums[follows], 0x20)
        sums = crc.combine(sums, hashes[at], lengths[at])
        column, ends = np.zeros(len(whole), np.uint32), np.zeros(len(whole), bool)
        column[at], ends[at] = sums % np.uint32(buckets), True
        columns.append(column)
        valid.append(ends)
    kept = np.stack(valid, axis=1)[len(before):]
    return np.stack(columns, axis=1)[len(before):][kept], kept.sum(axis=1)


def _slices(row: bytes, limit: int) -> Iterator[bytes]:
    """A delimited row in pieces of about ``limit`` bytes that part no word."""
    at = 0
    while at < len(row):
        cut = row.find(b" ", min(at + limit, len(row)))
        cut = len(row) if cut < 0 else cut
        yield row[at:cut]
        at = cut


def _width(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def _scanner(buckets: int, run: int, chunk: int):
    kind = _width(buckets)

    def one(row: bytes) -> tuple[int, np.ndarray]:
        """A row longer than a chunk, slice by slice."""
        before, words, parts = np.zeros(run - 1, np.uint64), 0, []
        for piece in _slices(row, chunk):
            found = scan(piece)
            words += len(found)
            parts.append(compose(found, before, buckets, run)[0].astype(kind))
            before = np.concatenate([before, found])[len(before) + len(found) - (run - 1):]
        return words, np.concatenate(parts) if parts else np.empty(0, kind)

    def many(rows: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
        found = scan((b" " + _MARK + b" ").join(rows))
        values, ends = compose(found, np.empty(0, np.uint64), buckets, run)
        row_of = np.cumsum(found == 0)
        words = np.bincount(row_of[found != 0], minlength=len(rows))
        stops = np.cumsum(np.bincount(row_of, weights=ends, minlength=len(rows)).astype(np.int64))
        values = values.astype(kind)
        for n, a, b in zip(words.tolist(), [0, *stops[:-1].tolist()], stops.tolist()):
            yield n, values[a:b]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, (data, offsets) = batch.column("doc_id"), text_buffer(batch.column("text"))
            for a, b in row_ranges(offsets, chunk):
                rows = [data[offsets[i]:offsets[i + 1]].tobytes().translate(_DELIMITED) for i in range(a, b)]
                found = [one(rows[0])] if len(rows) == 1 and len(rows[0]) > chunk else list(many(rows))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array([n for n, _ in found], pa.int64()),
                     pa.array([len(v) for _, v in found], pa.int64()),
                     pa.array([v.tobytes() for _, v in found], pa.binary())],
                    ["doc_id", "n_words", "n_features", "buckets"])

    return scanned


def feature_buckets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS,
                    run: int = RUN, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_words, n_features and buckets of each row; no shuffle.

    Words are the runs of 0-9, A-Z (lowered), a-z and non-ASCII characters;
    features are all runs of one to ``run`` consecutive words, joined by a
    space; ``buckets`` holds, in order, the CRC-32 of each feature's UTF-8
    bytes modulo ``buckets``, as unsigned numbers of 2 bytes (4 beyond 65,536
    buckets). A null or wordless text has no features. A text longer than
    ``chunk`` bytes is scanned in slices between words.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(_scanner(buckets, run, chunk), _SCANNED)


def _counter(buckets: int):
    kind = _width(buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for value in batch.column("buckets"):
                sums += np.bincount(np.frombuffer(value.as_buffer(), kind), minlength=buckets)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(sums[some], pa.int64())], ["bucket", "n"])

    return count


def bucket_counts(scanned: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all rows fall into each bucket; ``buckets`` numbers reach the driver."""
    sums = (scanned.select("buckets").mapInArrow(_counter(buckets), "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in sums.collect():
        out[bucket] = n
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket ``floor(1000 ln(((t + 1) (S + B)) / ((s + 1) (T + B))))``, in doubles."""
    n = len(raw)
    all_raw, all_target = float(int(raw.sum()) + n), float(int(target.sum()) + n)
    return np.array([math.floor(1000 * math.log((float(t + 1) * all_raw) / (float(s + 1) * all_target)))
                     for s, t in zip(raw.tolist(), target.tolist())], dtype=np.int64)


def gumbel(doc_id: int | None, seed: int = SEED) -> int:
    """A fixed draw for a document: ``floor(-1000 ln(-ln u))``, u from the SHA-256 of seed and id."""
    text = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(text.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scorer(gains: np.ndarray, seed: int):
    kind = _width(len(gains))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n = batch.column("doc_id"), batch.column("n_features")
            weights = [int(gains[np.frombuffer(v.as_buffer(), kind)].sum()) // m if m else 0
                       for v, m in zip(batch.column("buckets"), n.to_pylist())]
            scores = [w + gumbel(i, seed) for w, i in zip(weights, ids.to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [ids, batch.column("n_words"), n, pa.array(weights, pa.int64()), pa.array(scores, pa.int64())],
                ["doc_id", "n_words", "n_features", "weight", "score"])

    return score


def importance_sample(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                      target_text_col: str = "text", buckets: int = BUCKETS, run: int = RUN,
                      least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs``.

    A bucket's gain compares how often the features of ``target`` and of
    all ``docs`` fall into it; a document's weight is the floored mean gain
    of its features (none: 0). The score adds a Gumbel draw that seed and id
    fix, so the highest scores are a sample without replacement in proportion
    to the weights. Of the N rows with at least ``least_words`` words the
    ``percent * N // 100`` highest scores (ties: smaller id) have ranks from
    1; the others' rank is null.

    Texts are scanned once: the buckets are written to the shared folder,
    counted and scored from there. Only the ``buckets`` counts reach the
    driver. Ranks come from range partitions and their counts.

    A null text counts as empty. A null id draws as an empty id text and is
    last among ties; rows alike in id and score are ranked in no defined
    order. An empty ``target`` gains nothing but for its smoothing; no rows
    give none. Other columns are ignored.
    """
    spark = docs.sparkSession
    scanned = written(spark, feature_buckets(docs, id_col, text_col, buckets, run))
    gains = bucket_gains(bucket_counts(scanned, buckets),
                         bucket_counts(feature_buckets(target.select(F.lit(0).alias("doc_id"), F.col(target_text_col).alias("text")),
                                                       buckets=buckets, run=run), buckets))
    scored = scanned.mapInArrow(_scorer(gains, seed),
                                "doc_id long, n_words long, n_features long, weight long, score long")
    can = F.col("n_words") >= least_words
    order = [(~can).asc(), F.desc("score"), F.asc_nulls_last("doc_id")]  # the eligible rows come first
    ranked = global_rank(scored, order, "place", spread=[F.xxhash64("n_features", "weight")])
    drawn = percent * scanned.where(can).count() // 100
    return ranked.select("doc_id", "n_features", "weight", "score",
                         F.when(can & (F.col("place") <= drawn), F.col("place")).alias("rank"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, resampled towards the benchmark's texts."""
    return importance_sample(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
