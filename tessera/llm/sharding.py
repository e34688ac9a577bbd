"""Sharding by weighted rendezvous hashing of stable record keys."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import load

SHARDS = 24
ROWS_PER_BUCKET = 50_000
OVERHEAD = 8  # bytes counted for a record beside its text


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard, 0 to ``len(weights) - 1``, with the highest score for ``key``.

    Shard ``i`` scores ``weight / -ln(u)`` with ``u`` in (0, 1) hashed from
    (key, i) alone. So a shard's share follows its weight, and another shard
    takes rows only into itself: no other score changes. A null key hashes
    like any other value. Equal scores go to the larger shard.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a positive weight")
    scored = []
    for i, w in enumerate(weights):
        u = (F.shiftrightunsigned(F.xxhash64(F.lit(i), key), 11) + F.lit(0.5)) * F.lit(2.0 ** -53)
        scored.append(F.struct((F.lit(float(w)) / -F.log(u)).alias("score"), F.lit(i).alias("shard")))
    best = F.greatest(*scored) if len(scored) > 1 else scored[0]
    return best["shard"]


def shard_documents(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, *, grown_by: float = 1.0,
                    id_col: str = "doc_id", text_col: str = "text",
                    rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Every row with its shard, its slot in the shard and its shard after growth.

    Returns doc_id, size (UTF-8 bytes of the text plus 8; a null text has
    none), text_crc32 (of the UTF-8 bytes; 0 for null and empty), law
    (``key``), shard, slot (0, 1, ... within the shard, without gaps) and
    grown_shard (with one more shard of weight ``grown_by``).

    Slots come from prefix sums: rows are counted per (shard, hash bucket),
    the buckets' counts are added up within the shard, and only a bucket is
    ever numbered in one task. Rows alike in id, size and checksum are
    counted before they are shuffled and written out again at the end, so
    that one repeated key fills no task. Only these three numbers are
    shuffled, never the text.

    Null ids share one key. Repeated rows each keep a row and a slot. An
    empty table gives no rows. Other input columns are ignored.
    """
    id_type = docs.schema[id_col].dataType
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(OVERHEAD)).alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"))
    total = docs.select(F.count(F.lit(1))).first()[0]  # one number
    buckets = max(1, math.ceil(total / (len(weights) * rows_per_bucket)))

    alike = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    placed = alike.select(
        "*", rendezvous(F.col("doc_id"), weights).alias("shard"),
        F.pmod(F.xxhash64(F.lit("slot"), "doc_id", "size", "text_crc32"), F.lit(buckets)).alias("bucket"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy("shard", "bucket").agg(F.sum("n").alias("n"))
              .select(F.col("shard"), F.col("bucket"),
                      F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    upto = (Window.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32")
            .rowsBetween(Window.unboundedPreceding, 0))
    numbered = placed.withColumn("upto", F.sum("n").over(upto)).join(starts, ["shard", "bucket"])
    grown = rendezvous(F.col("doc_id"), [*weights, grown_by])
    return numbered.select(
        F.col("doc_id").cast(id_type).alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("start") + F.col("upto") - F.col("n")).alias("first"),
        grown.alias("grown_shard"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("k"),
    ).select("doc_id", "size", "text_crc32", "law", F.col("shard").cast("int").alias("shard"),
             (F.col("first") + F.col("k")).alias("slot"), F.col("grown_shard").cast("int").alias("grown_shard"))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 24 equal shards."""
    return shard_documents(load(spark, sf_dir, "documents"))
