"""Regression tests for defects found in review."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators import failure_streak, option_expand, top_n_rows, ttl_exclude, value_share


def test_helper_column_names_never_overwrite_input(spark):
    c = spark.createDataFrame([(1, "u", dt.datetime(2024, 1, 1), 5, 7)],
                              "id int, k string, ts timestamp_ntz, _b int, _us int")
    e = spark.createDataFrame([], "k string, ts timestamp_ntz")
    out = ttl_exclude(c, e, "k", "ts").collect()
    assert [(r._b, r._us) for r in out] == [(5, 7)]
    clash = c.withColumn("__b", F.lit(1))
    with pytest.raises(ValueError, match="reserved"):
        ttl_exclude(clash, e, "k", "ts")
    with pytest.raises(ValueError, match="reserved"):
        top_n_rows(c.withColumn("__rn", F.lit(1)), ["k"], "id", 1)
    with pytest.raises(ValueError, match="reserved"):
        failure_streak(c.withColumn("__f", F.lit(1)), "k", "ts", F.lit(True), keep=["__f"])
    regions = spark.createDataFrame([("r", "z")], "region string, zone string")
    with pytest.raises(ValueError, match="clash"):
        option_expand(regions, "region", ["a"], keep=["zone"])


def test_value_share_on_numeric_column(spark):
    df = spark.createDataFrame([(2,), (2,), (3,), (None,)], "s int")
    got = [tuple(r) for r in value_share(df, "s", ["2", "x"]).collect()]
    assert got == [(2, 0.5), (None, 0.0)]


def test_file_date_ignores_the_file_name(spark):
    from tessera.sources import file_date
    df = spark.createDataFrame([("file:/logs/2024-01-04/log-2024-01-05.txt", "/r/2024-01-04")],
                               "p string, d string")
    assert df.select(file_date(F.col("p"), strip_file_name=True)).first()[0] == dt.date(2024, 1, 4)
    assert df.select(file_date(F.col("d"))).first()[0] == dt.date(2024, 1, 4)


def test_build_session_with_static_sql_setting(spark):
    from tessera.session import build_session
    again = build_session(extra={"spark.sql.warehouse.dir": "/tmp/ignored-warehouse",
                                 "spark.sql.custom.plugin.setting": "on"})
    assert again is spark
    assert spark.conf.get("spark.sql.custom.plugin.setting") == "on"


def test_group_listed_twice_is_tried_at_both_positions(spark):
    from tessera.operators import cheapest_under_limit
    t = dt.datetime(2024, 1, 1, 12)
    prices = spark.createDataFrame([("view", "z1", t, 50.0)], "grp string, opt string, ts timestamp_ntz, value double")
    prefs = spark.createDataFrame([(1, "view", 10.0), (2, "view", 100.0)], "pos int, grp string, max_price double")
    got = [tuple(r) for r in cheapest_under_limit(prices, prefs, "grp", "opt", "value", "ts").collect()]
    assert got == [(2, "view", "z1", 50.0)]


def test_severity_uses_the_index_not_the_pos_value(spark):
    from tessera.operators import cheapest_under_limit
    t = dt.datetime(2024, 1, 1, 12)
    prices = spark.createDataFrame([("a", "z", t, 1.0), ("b", "z", t, 1.0), ("c", "z", t, 1.0)],
                                   "grp string, opt string, ts timestamp_ntz, value double")
    prefs = spark.createDataFrame([(10, "a", 5.0), (20, "b", 5.0), (30, "c", 5.0)],
                                  "pos int, grp string, max_price double")
    got = cheapest_under_limit(prices, prefs, "grp", "opt", "value", "ts", with_severity=True).first()
    assert (got.pos, got.severity) == (10, None)
    prefs2 = spark.createDataFrame([(10, "x", 5.0), (20, "y", 5.0), (30, "c", 5.0)],
                                   "pos int, grp string, max_price double")
    got = cheapest_under_limit(prices, prefs2, "grp", "opt", "value", "ts", with_severity=True).first()
    assert (got.pos, got.severity) == (30, "CRITICAL")


def test_fill_empty_keeps_a_null_keys_average(spark):
    from tessera.operators import trailing_topn_avg
    t = dt.datetime(2024, 1, 1, 12)
    df = spark.createDataFrame([(None, t, 42.0), ("a", t, 1.0), ("old", dt.datetime(2023, 1, 1), 5.0)],
                               "k string, ts timestamp_ntz, v double")
    got = sorted(((r.k or ""), r.avg_top) for r in
                 trailing_topn_avg(df, "k", "v", "ts", hours=1, fill_empty=True).collect())
    assert got == [("", 42.0), ("a", 1.0), ("old", 0.0)]


def test_stream_triggers_and_zero_timeout(spark, scratch):
    from tessera.sources import lines_frame
    from tessera.streaming import run_word_count_stream, start_word_count_stream
    src = f"{scratch}/src"
    lines_frame(spark, ["a b", "b"]).write.text(src)
    q = start_word_count_stream(spark, src, f"{scratch}/s1", f"{scratch}/c1", processing_time="1 second")
    try:
        assert q.isActive
        q.processAllAvailable()
    finally:
        q.stop()
    with pytest.raises(ValueError):
        start_word_count_stream(spark, src, f"{scratch}/s2", f"{scratch}/c2",
                                processing_time="1 second", available_now=True)
    with pytest.raises(TimeoutError):
        run_word_count_stream(spark, src, f"{scratch}/s3", f"{scratch}/c3", timeout_sec=0)
    assert not spark.streams.active
