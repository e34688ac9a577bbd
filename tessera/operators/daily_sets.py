"""Exact sets per day as bitmaps: distinct counts over any range of days without the rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ranks import global_rank


def dense_ids(values: DataFrame, col: str, known: DataFrame | None = None) -> DataFrame:
    """(``col``, id): a number from 1 on, without gaps, for each distinct non-null value.

    With ``known`` (a table of this form) its numbers stay and new values
    are numbered after them, so sets made before remain valid. Numbers come
    from range partitions and their counts (see ``global_rank``).
    """
    distinct = values.select(col).where(F.col(col).isNotNull()).distinct()
    if known is None:
        return global_rank(distinct, [F.asc(col)], "id").select(col, "id")
    added = global_rank(distinct.join(known.select(col), col, "left_anti"), [F.asc(col)], "id")
    most = known.select(F.coalesce(F.max("id"), F.lit(0).cast("bigint"))).scalar()
    return known.select(col, "id").unionByName(added.select(col, (F.col("id") + most).alias("id")))


def daily_sets(rows: DataFrame, day: str, id_col: str, sets: dict[str, Column]) -> DataFrame:
    """(``day``, name, bucket, bits): per day and set the ids that it holds, as bitmaps of 32,768 ids each.

    ``sets`` maps a set's name to the condition on which a row's id is in
    it. Each task merges its rows into bitmaps before the shuffle, so an id
    with a third of all rows is one bit. Rows without a day or id are in no set.
    """
    names = F.array(*[F.when(condition, F.lit(name)) for name, condition in sets.items()])
    held = (rows.where(F.col(day).isNotNull() & F.col(id_col).isNotNull())
            .select(day, F.col(id_col).cast("bigint").alias("id"), F.explode(F.array_compact(names)).alias("name")))
    return (held.groupBy(day, "name", F.bitmap_bucket_number("id").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits")))


def distinct_over_ranges(sets: DataFrame, day: str, ranges: Sequence[tuple[dt.date, dt.date]],
                         names: Sequence[str]) -> DataFrame:
    """(date_from, date_to, one count for each name): distinct ids over each range of days, both ends included.

    The bitmaps of a range's days are merged by bucket; the rows that they
    were made of are not read. Ranges may overlap; one without ids counts 0.
    Days outside all ranges are not read.
    """
    spark = sets.sparkSession
    wanted = spark.createDataFrame([(a, b) for a, b in ranges], "date_from date, date_to date")
    if not ranges:
        return wanted.select("*", *[F.lit(0).cast("bigint").alias(f"n_{n}") for n in names])
    every = F.array(*[F.struct(F.lit(a).alias("date_from"), F.lit(b).alias("date_to")) for a, b in ranges])
    inside = F.filter(every, lambda r: (r.date_from <= F.col(day)) & (F.col(day) <= r.date_to))
    within = sets.where((F.col(day) >= F.lit(min(a for a, _ in ranges))) & (F.col(day) <= F.lit(max(b for _, b in ranges))))
    merged = (within.select("name", "bucket", "bits", F.explode(inside).alias("r"))
              .groupBy("r", "name", "bucket").agg(F.bitmap_or_agg("bits").alias("bits")))
    counts = (merged.groupBy("r").pivot("name", list(names)).agg(F.sum(F.bitmap_count("bits")))
              .select("r.date_from", "r.date_to", *[F.col(n).alias(f"n_{n}") for n in names]))
    zero = F.lit(0).cast("bigint")
    return wanted.join(counts, ["date_from", "date_to"], "left").select(
        "date_from", "date_to", *[F.coalesce(f"n_{n}", zero).alias(f"n_{n}") for n in names])


def affected_over_ranges(sets: DataFrame, day: str, ranges: Sequence[tuple[dt.date, dt.date]]) -> DataFrame:
    """(date_from, date_to, n_affected, n_total, share) from sets named ``affected`` and ``total``."""
    counts = distinct_over_ranges(sets, day, ranges, ["affected", "total"])
    share = F.try_divide(F.col("n_affected").cast("double"), F.col("n_total").cast("double"))
    return counts.select("date_from", "date_to", "n_affected", "n_total", share.alias("share"))
