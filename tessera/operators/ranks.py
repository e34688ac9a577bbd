"""Ranks over a whole sorted result, without a window that one task runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.matching import check_free
from tessera.operators.shares import key_counts
from tessera.operators.text import word_count
from tessera.session import scratch

_INDEX_BITS = 33  # fixed value: monotonically_increasing_id keeps a row's place in its partition in these bits


def global_rank(df: DataFrame, order: Sequence[Column], rank: str = "rnk",
                spread: Sequence[Column] = ()) -> DataFrame:
    """``df`` with the 1-based place (BIGINT) of each row in ascending ``order``, every row ranked.

    As ``row_number() over (order by ...)``, which would move all rows to
    one task. Here Spark's range partitioning deals the rows out in order,
    each partition sorts its own and numbers them in place, and the counts
    of the partitions, one row each, give the number of rows before each of
    them. The numbered rows are written to the shared folder once, so counts
    and rows come from the same partitions.

    ``order`` is a list of sort expressions (``F.desc("cnt")``, ...). Rows
    that agree in all of it are ranked in no defined order and share a
    partition, unless ``spread`` names further expressions that part them.
    Nulls are placed as the sort expressions say. No rows give no rows.
    """
    check_free(df, [rank, "__m", "__part", "__before"])
    spark = df.sparkSession
    path, by = scratch(spark), [*order, *spread]
    placed = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__m", F.monotonically_increasing_id())
    placed.write.parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path)
    part = F.shiftright("__m", _INDEX_BITS)
    # one row for each partition: a window over these few numbers them all
    upto = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = (rows.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
              .select("__part", F.coalesce(F.sum("__n").over(upto), F.lit(0)).alias("__before")))
    inside = F.col("__m").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    # as many rows as partitions, each of two numbers
    return (rows.withColumn("__part", part).join(F.broadcast(before), "__part")
            .select(*df.columns, (F.col("__before") + inside + 1).alias(rank)))


def word_rank(df: DataFrame, text_col: str = "value") -> DataFrame:
    """Every word with its count and rank: count descending, then word descending.

    ``(rnk, word, cnt)``; the first rows are those of ``word_count_topk``,
    for any k.
    """
    ranked = global_rank(word_count(df, text_col), [F.desc("cnt"), F.desc("word")])
    return ranked.select("rnk", "word", "cnt")


def key_rank(df: DataFrame, col: str) -> DataFrame:
    """Every key with its count, share of all rows and rank: count descending, then key ascending.

    ``(rnk, col, cnt, share)``; the first rows are those of ``topk_share``.
    A null key counts as a key and comes before others of its count.
    """
    total = df.select(F.count(F.lit(1))).scalar()
    ranked = global_rank(key_counts(df, col), [F.desc("cnt"), F.asc(col)])
    return ranked.select("rnk", col, "cnt", (F.col("cnt").cast("double") / total).alias("share"))
