"""Ranks of a whole sorted result: no window over all rows, any order, ties, nulls."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import global_rank, key_rank, topk_share, word_count_topk, word_rank

SCHEMA = "k long, v double, name string"


def made(n, seed=1):
    rng = random.Random(seed)
    return [(i, rng.choice([None, 1.0, 2.5, rng.random()]), rng.choice([None, "a", "b", ""])) for i in range(n)]


def test_equals_the_sorted_place(spark):
    data = made(5000)
    got = global_rank(spark.createDataFrame(data, SCHEMA).repartition(7),
                      [F.col("v").desc_nulls_last(), F.col("name").asc_nulls_first(), F.asc("k")]).collect()
    want = sorted(data, key=lambda r: (r[1] is None, -(r[1] or 0), r[2] is not None, r[2] or "", r[0]))
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r.rnk)] == want
    assert sorted(r.rnk for r in got) == list(range(1, 5001))


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few_rows(spark, n):
    got = global_rank(spark.createDataFrame(made(n), SCHEMA), [F.asc("k")])
    assert got.columns == ["k", "v", "name", "rnk"] and sorted(r.rnk for r in got.collect()) == list(range(1, n + 1))


def test_ties_get_different_ranks_and_can_be_spread(spark):
    df, coalesce = spark.range(4000).select(F.lit(1).alias("x"), F.col("id")), "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        got = global_rank(df, [F.asc("x")], spread=[F.xxhash64("id")])
    finally:
        spark.conf.set(coalesce, "true")
    assert sorted(r.rnk for r in got.collect()) == list(range(1, 4001))
    sizes = [spark.read.parquet(f).count() for f in got.inputFiles()]
    assert max(sizes) < 2000


def test_reserved_names(spark):
    with pytest.raises(ValueError):
        global_rank(spark.range(3).withColumnRenamed("id", "rnk"), [F.asc("rnk")])


def test_no_window_over_the_rows(spark):
    df = global_rank(spark.range(1000), [F.desc("id")])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # the only window stands above the counts of partitions
    window = plan[plan.index("Window"):]
    assert plan.count("Window") == 1 and "Aggregate" in window


def test_first_ranks_are_those_of_the_top_k(spark):
    lines = spark.createDataFrame([("b a c a",), ("c d d' É é",), (None,)], "value string")
    full = word_rank(lines).collect()
    assert sorted(tuple(r) for r in full if r.rnk <= 3) == [tuple(r) for r in word_count_topk(lines, 3).collect()]
    keys = spark.createDataFrame([("x",), ("y",), ("x",), (None,), ("z",)], "page string")
    top = [tuple(r) for r in topk_share(keys, "page", 3).collect()]
    assert [tuple(r)[1:] for r in sorted(key_rank(keys, "page").collect()) if r.rnk <= 3] == top
