"""Every job on empty inputs: no error, no rows (or one zero/null row for totals)."""

from pyspark.sql import functions as F

from tessera.operators import (
    affected_share, anagram_groups, cheapest_under_limit, choice_severity, failure_streak,
    line_count, option_expand, pair_digest_match, topk_share, trailing_topn_avg, ttl_exclude,
    value_share, word_count, word_count_topk,
)

EV = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"


def test_text_jobs_on_empty(spark):
    lines = spark.createDataFrame([], "value string")
    assert word_count(lines).count() == 0
    assert word_count_topk(lines, 5).count() == 0
    assert anagram_groups(lines).count() == 0
    assert line_count(lines).first().n_lines == 0
    docs = spark.createDataFrame([], "text string")
    assert line_count(docs, "text", whole_documents=True).first().n_lines == 0


def test_share_jobs_on_empty(spark):
    df = spark.createDataFrame([], "id string, status string")
    assert [tuple(r) for r in value_share(df, "status", ["x"]).collect()] == [("x", None)]
    assert topk_share(df, "status", 3).count() == 0
    r = affected_share(df, df.withColumnRenamed("status", "ip"), "id", "status", "x", "id", "ip").first()
    assert (r.n_affected, r.n_total, r.share) == (0, 0, None)


def test_matching_jobs_on_empty(spark):
    pairs = spark.createDataFrame([], "a string, b string")
    digests = spark.createDataFrame([], "digest string")
    assert pair_digest_match(pairs, digests, "a", "b").count() == 0
    ev = spark.createDataFrame([], EV)
    assert ttl_exclude(ev, ev.select("user_id", "ts"), "user_id", "ts").count() == 0
    regions = spark.createDataFrame([], "region string")
    assert option_expand(regions, "region", ["a"]).count() == 0


def test_series_jobs_on_empty(spark):
    ev = spark.createDataFrame([], EV)
    assert trailing_topn_avg(ev, "event_type", "value", "ts").count() == 0
    prefs = spark.createDataFrame([(1, "view", 10.0)], "pos int, event_type string, max_price double")
    empty = cheapest_under_limit(ev, prefs, "event_type", "user_id", "value", "ts")
    assert empty.count() == 0
    assert empty.dtypes == [("pos", "int"), ("event_type", "string"), ("user_id", "bigint"), ("price", "double")]
    assert failure_streak(ev, "user_id", "ts", F.col("event_type") == "error").count() == 0
    none = spark.createDataFrame([], "pos int")
    assert choice_severity(none, "pos").count() == 0


def test_partitioned_text_of_an_empty_write(spark, scratch):
    from tessera.sources import read_partitioned_text
    root = f"{scratch}/empty_days"
    spark.createDataFrame([], "day date, value string").write.partitionBy("day").text(root)
    df = read_partitioned_text(spark, root, "day", date_from="2024-01-01")
    assert line_count(df).first().n_lines == 0
