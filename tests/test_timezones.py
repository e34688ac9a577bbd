"""Zoned timestamps (TIMESTAMP, not TIMESTAMP_NTZ) under a non-UTC session zone, across DST."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import failure_streak, trailing_topn_avg, ttl_exclude

UTC = dt.timezone.utc
# 2024-03-10 07:00 UTC is 02:00 local in New York, where clocks jump to 03:00
DST = dt.datetime(2024, 3, 10, 7, 0, tzinfo=UTC)


@pytest.fixture()
def new_york(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", old)


def at(hours):
    return DST + dt.timedelta(hours=hours)


def test_ttl_exclude_zoned_across_dst(new_york):
    rnd = random.Random(5)
    cands = [(i, rnd.choice("ab"), at(rnd.uniform(-6, 6))) for i in range(200)]
    excl = [(rnd.choice("ab"), at(rnd.uniform(-6, 6))) for _ in range(20)]
    c = new_york.createDataFrame(cands, "id int, k string, ts timestamp")
    e = new_york.createDataFrame(excl, "k string, ts timestamp")
    got = sorted(r.id for r in ttl_exclude(c, e, "k", "ts", 1.0).collect())
    life = dt.timedelta(hours=1)
    want = sorted(i for i, k, t in cands if not any(ek == k and et <= t < et + life for ek, et in excl))
    assert got == want


def test_trailing_window_zoned(new_york):
    rows = [("g", at(-3), 5.0), ("g", at(-0.5), 1.0), ("g", at(0.5), 3.0)]
    df = new_york.createDataFrame(rows, "k string, ts timestamp, v double")
    # as_of = latest ts = at(0.5); a 2-hour window starts at at(-1.5) (real time)
    got = trailing_topn_avg(df, "k", "v", "ts", hours=2, n=10).first().avg_top
    assert got == 2.0


def test_failure_streak_zoned(new_york):
    rows = [(1, "u", at(-1), True), (2, "u", at(0.2), True), (3, "u", at(0.4), False), (4, "u", at(1), True)]
    df = new_york.createDataFrame(rows, "id int, k string, ts timestamp, failed boolean")
    out = failure_streak(df, "k", "ts", F.col("failed"), order_by=["id"], cap=None, keep=["id"])
    assert sorted((r.id, r.streak) for r in out.collect()) == [(1, 1), (2, 2), (4, 1)]


def test_lookback_ntz_in_dst_gap_is_wall_clock(new_york):
    from tessera.functions import lookback_start
    got = new_york.range(1).select(lookback_start("2024-03-10 03:30:00.5", 1.0).alias("x")).first().x
    assert got == dt.datetime(2024, 3, 10, 2, 30, 0)


def test_default_as_of_in_dst_overlap_keeps_the_instant(new_york):
    # 01:30 EST on 2024-11-03 is the second 01:30 of that night
    last = dt.datetime(2024, 11, 3, 6, 30, tzinfo=UTC)
    rows = [("g", last - dt.timedelta(minutes=50), 2.0), ("g", last, 4.0)]
    df = new_york.createDataFrame(rows, "k string, ts timestamp, v double")
    got = trailing_topn_avg(df, "k", "v", "ts", hours=0.5, n=10).first().avg_top
    assert got == 4.0


def test_aware_as_of_on_ntz_column_is_taken_to_utc(spark):
    rows = [("g", dt.datetime(2024, 1, 1, 0, 0), 1.0), ("g", dt.datetime(2024, 1, 1, 6, 0), 9.0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    five = dt.timezone(dt.timedelta(hours=5))
    as_of = dt.datetime(2024, 1, 1, 5, 0, tzinfo=five)  # = 00:00 UTC
    got = trailing_topn_avg(df, "k", "v", "ts", hours=1, n=10, as_of=as_of).first().avg_top
    assert got == 1.0
