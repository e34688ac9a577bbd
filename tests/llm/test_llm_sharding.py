"""Rendezvous sharding: laws, growth, slots, odd rows."""

import math
import struct
import zlib
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

from tessera.llm.sharding import op1_sharding, rendezvous, shard_documents

from llm_helpers import nothing, odd  # noqa: F401

SF = "/root/testdata/sf0.01"


def check(rows, docs, shards):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
        assert r.law == "key" and 0 <= r.shard < shards
        assert r.grown_shard in (r.shard, shards)
    for slots in by.values():
        assert sorted(slots) == list(range(len(slots)))
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want


def test_all_documents(spark):
    rows = op1_sharding(spark, SF).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(rows, docs, 24)
    counts = Counter(r.shard for r in rows)
    assert len(counts) == 24 and max(counts.values()) < 3 * len(rows) / 24
    moved = sum(r.shard != r.grown_shard for r in rows)
    assert 0 < moved < 3 * len(rows) / 25


def test_small_buckets_give_the_same_shards(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = {r.doc_id: r.shard for r in shard_documents(docs).collect()}
    rows = shard_documents(docs, rows_per_bucket=5).collect()
    assert {r.doc_id: r.shard for r in rows} == one
    check(rows, [(r.doc_id, r.text) for r in docs.collect()], 24)


def test_odd_rows_and_no_rows(spark, odd, nothing):
    check(shard_documents(odd, [1.0] * 3).collect(), [(r.doc_id, r.text) for r in odd.collect()], 3)
    assert shard_documents(nothing).collect() == []


def test_one_repeated_row_is_a_third_of_all(spark):
    df = spark.range(600).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"),
                                 F.lit("same").alias("text"))
    check(shard_documents(df, [1.0] * 4, rows_per_bucket=10).collect(),
          [(r.doc_id, r.text) for r in df.collect()], 4)


def test_weights_set_the_shares(spark):
    df = spark.range(20_000).select(rendezvous(F.col("id"), [3.0, 1.0]).alias("s"))
    assert abs(df.where("s = 0").count() / 20_000 - 0.75) < 0.02


def score(i, key, weight):
    """What a shard scores for a long key, worked out apart from Spark."""
    h = xxhash.xxh64(struct.pack("<q", key), seed=xxhash.xxh64(struct.pack("<i", i), seed=42).intdigest()).intdigest()
    return weight / -math.log(((h >> 11) + 0.5) * 2.0 ** -53)


def test_every_row_is_in_its_best_scoring_shard(spark):
    rows = op1_sharding(spark, SF).select(F.col("doc_id").cast("long").alias("doc_id"), "shard", "grown_shard").collect()
    assert spark.read.parquet(f"{SF}/documents.parquet").schema["doc_id"].dataType.simpleString() == "bigint"
    for r in rows:
        scores = [score(i, r.doc_id, 1.0) for i in range(25)]
        assert r.shard == max(range(24), key=lambda i: scores[i])
        assert r.grown_shard == max(range(25), key=lambda i: scores[i])
    weights = [0.5, 4.0, 1.5]
    for r in spark.range(-300, 300).select("id", rendezvous(F.col("id"), weights).alias("s")).collect():
        assert r.s == max(range(3), key=lambda i: score(i, r.id, weights[i]))
