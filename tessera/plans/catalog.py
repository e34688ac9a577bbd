"""The job registry: each named job bound to the test tables.

Every entry takes ``(spark, sf_dir)`` and returns a DataFrame computed from
the whole tables of ``sf_dir`` (or data Spark derives from them). Values
given here (wanted status values, limits, suffixes) are job parameters.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import pair_digest
from tessera.operators import (
    affected_over_ranges, affected_share, anagram_groups, anagram_members, cheapest_under_limit, choice_severity, choices_over_time,
    daily_sets, dense_ids, failure_streak, line_count, option_expand, pair_digest_match, topk_share,
    trailing_topn_avg, trailing_topn_series, ttl_exclude, value_share, word_count, word_count_topk, word_rank,
)
from tessera.operators.shares import format_share_lines
from tessera.operators.text import format_ranked
from tessera.plans import jobs
from tessera.session import scratch
from tessera.sources import is_directory, read_incremental, run_incremental, path_date, read_partitioned_text, read_text_dirs, table
from tessera.sources.text_dirs import all_dirs
from tessera.streaming import (
    failure_streak_stream_df, read_stream, run_append_stream, run_word_count_stream, run_word_topk_stream,
    ttl_exclude_stream_df,
)

# Job parameters used by the registered queries.
WANTED_EVENT_TYPES = ["error", "click", "none"]
TOP_WORDS = 1000
TOP_KEYS = 5
# (pos, group, max_price): the preference order of cheapest_under_limit.
PREFERENCES = [(1, "view", 20.0), (2, "click", 60.0), (3, "error", 500.0)]
ZONE_SUFFIXES = ["a", "b", "c", "e"]
GUESSED_SEGMENT = "AUTOMOBILE"
ROUND_DIGITS = 6
RECENT_DAYS = 14
FILES_PER_DAY = 8
# event types in the order in which they are preferred
PREFERRED_TYPES = ["click", "error", "purchase", "signup", "view"]
# (pos, group, max_price): a limit nobody meets, then a group without a limit
STRICT_PREFERENCES = [(1, "view", 0.001), (2, "purchase", 0.001), (3, "HOUSEHOLD", None), (4, "click", 500.0)]
CAP = 2
ARRIVALS = 4  # parts in which events come to a stream


def documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("text")


def _one_line(*cols) -> Column:
    """Fields as one text line; a line break within a field becomes a space, as it would end the line."""
    return F.regexp_replace(F.concat_ws(" ", *[F.col(c).cast("string") if isinstance(c, str) else c for c in cols]),
                            "[\\r\\n]", " ")


def _lines(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Text lines (``value``) that Spark writes to the shared folder and reads back as text files."""
    root = scratch(spark)
    rows.write.text(root)
    return read_text_dirs(spark, root)


def q_line_count(spark: SparkSession, d: str) -> DataFrame:
    return line_count(table(spark, d, "documents"), "text", whole_documents=True)


def q_dated_line_count(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the last ``RECENT_DAYS`` days of a dated, completed text table.

    The events are rendered as text lines and written once by Spark into
    day folders (``partitionBy``) under the shared scratch folder; the read
    requires the write's ``_SUCCESS`` marker and prunes the day folders
    before the latest day (read off the folder names) minus ``RECENT_DAYS``.
    """
    ev = table(spark, d, "events")
    root = scratch(spark)
    day = F.to_date("ts")
    (ev.select(day.alias("day"), _one_line("event_id", "event_type", "value").alias("value"),
               F.pmod(F.xxhash64("event_id"), F.lit(FILES_PER_DAY)).alias("part"))
     .repartition("day", "part").drop("part")  # so many files a day at most, however many tasks read
     .write.partitionBy("day").text(root))
    # the latest day from the day folders' names: a listing, not a scan
    days = [path_date(p) for p in all_dirs(spark, root, "day=*")]
    days = [x for x in days if x is not None]
    start = (max(days) - dt.timedelta(days=RECENT_DAYS)) if days else None
    return line_count(read_partitioned_text(spark, root, "day", date_from=start))


def q_word_count(spark: SparkSession, d: str) -> DataFrame:
    return word_count(documents(spark, d), "text")


def q_word_count_topk(spark: SparkSession, d: str) -> DataFrame:
    return word_count_topk(documents(spark, d), TOP_WORDS, "text")


def q_word_rank(spark: SparkSession, d: str) -> DataFrame:
    return word_rank(documents(spark, d), "text")


def q_key_rank(spark: SparkSession, d: str) -> DataFrame:
    """Every page of the order log with its share and rank."""
    return jobs.ranked_pages(_status_lines(spark, d))


def q_value_share(spark: SparkSession, d: str) -> DataFrame:
    return value_share(table(spark, d, "events"), "event_type", WANTED_EVENT_TYPES)


def q_affected_share(spark: SparkSession, d: str) -> DataFrame:
    return affected_share(table(spark, d, "orders"), table(spark, d, "customer"),
                          status_id="o_custkey", status_col="o_orderstatus", status_value="P",
                          address_id="c_custkey", address_col="c_name")


def q_topk_share(spark: SparkSession, d: str) -> DataFrame:
    return topk_share(table(spark, d, "part"), "p_type", TOP_KEYS)


def q_anagram_groups(spark: SparkSession, d: str) -> DataFrame:
    return anagram_groups(documents(spark, d), "text", whole_documents=True)


def q_pair_digest_match(spark: SparkSession, d: str) -> DataFrame:
    cust = table(spark, d, "customer")
    # The digest list: every customer name paired with one guessed segment.
    digests = cust.select(pair_digest("c_name", F.lit(GUESSED_SEGMENT)).alias("digest"))
    return pair_digest_match(cust, digests, "c_name", "c_mktsegment")


def q_option_expand(spark: SparkSession, d: str) -> DataFrame:
    return option_expand(table(spark, d, "customer"), "c_name", ZONE_SUFFIXES, sep="-")


def q_trailing_topn_avg(spark: SparkSession, d: str) -> DataFrame:
    return trailing_topn_avg(table(spark, d, "events"), "event_type", "value", "ts",
                             hours=12, n=10, digits=ROUND_DIGITS)


def _preferences(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PREFERENCES, "pos int, event_type string, max_price double")


def q_cheapest_under_limit(spark: SparkSession, d: str) -> DataFrame:
    return cheapest_under_limit(table(spark, d, "events"), _preferences(spark),
                                grp="event_type", opt="user_id", value="value", ts="ts",
                                digits=ROUND_DIGITS)


def q_cheapest_without_limit(spark: SparkSession, d: str) -> DataFrame:
    """The choice with exclusions, severity and a group without a limit.

    That group, a market segment, has no prices: its options are its
    customers, in order of their keys. Customers (and users) with an error within three hours are
    excluded.
    """
    ev = table(spark, d, "events")
    errors = ev.where(F.col("event_type") == "error").select("user_id", "ts")
    listed = table(spark, d, "customer").select(F.col("c_mktsegment").alias("event_type"),
                                                F.col("c_custkey").alias("user_id"))
    prefs = spark.createDataFrame(STRICT_PREFERENCES, "pos int, event_type string, max_price double")
    return cheapest_under_limit(ev, prefs, grp="event_type", opt="user_id", value="value", ts="ts",
                                exclusions=errors, digits=ROUND_DIGITS, with_severity=True, options=listed)


def q_choice_severity(spark: SparkSession, d: str) -> DataFrame:
    """Severity of each event type present, by its place in the preference list."""
    prefs = spark.createDataFrame(list(enumerate(PREFERRED_TYPES, 1)), "pos bigint, event_type string")
    kinds = table(spark, d, "events").select("event_type").distinct()
    chosen = kinds.join(prefs, "event_type")
    return choice_severity(chosen, "pos", len(PREFERRED_TYPES)).select("event_type", "pos", "severity")


def q_ttl_exclude(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events")
    cand = ev.where(F.col("event_type") == "view").select("event_id", "user_id", "ts")
    excl = ev.where(F.col("event_type") == "error").select("user_id", "ts")
    return ttl_exclude(cand, excl, "user_id", "ts", ttl_hours=3).select("event_id", "user_id")


def _events_with_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Events; every seventh has no user, so that null keys occur."""
    user = F.when(F.pmod(F.col("event_id"), F.lit(7)) == 0, F.lit(None)).otherwise(F.col("user_id"))
    return table(spark, d, "events").select("event_id", user.cast("bigint").alias("user_id"), "ts", "event_type")


def q_failure_streak(spark: SparkSession, d: str) -> DataFrame:
    return failure_streak(_events_with_gaps(spark, d), "user_id", "ts", F.col("event_type") == "error",
                          order_by=["event_id"], cap=CAP, keep=["event_id"])


def q_failure_streak_health(spark: SparkSession, d: str) -> DataFrame:
    """The counter that restarts at its cap only on a healthy row (here: two of three events)."""
    return failure_streak(_events_with_gaps(spark, d), "user_id", "ts",
                          F.col("event_type").isin("error", "click"), order_by=["event_id"], cap=CAP,
                          keep=["event_id"], healthy=F.pmod(F.col("event_id"), F.lit(3)) != 0)


def q_anagram_members(spark: SparkSession, d: str) -> DataFrame:
    return anagram_members(documents(spark, d), "text", whole_documents=True)


# ---- jobs over raw text lines, which Spark renders from the tables -----------------------

def _status_lines(spark: SparkSession, d: str) -> DataFrame:
    """``<customer> <page> <status>`` lines, one per order."""
    page = F.concat(F.lit("/page"), F.pmod(F.col("o_orderkey"), F.lit(97)).cast("string"))
    return _lines(spark, table(spark, d, "orders").select(_one_line("o_custkey", page, "o_orderstatus")))


def q_status_share(spark: SparkSession, d: str) -> DataFrame:
    return jobs.status_share(_status_lines(spark, d), ["F", "O", "P", "X"])


def q_affected_ip_share(spark: SparkSession, d: str) -> DataFrame:
    addresses = _lines(spark, table(spark, d, "customer").select(_one_line("c_custkey", "c_name")))
    return jobs.affected_ip_share(_status_lines(spark, d), addresses, "P")


def q_top_pages_share(spark: SparkSession, d: str) -> DataFrame:
    return jobs.top_pages_share(_status_lines(spark, d), TOP_KEYS)


def q_top_pages_lines(spark: SparkSession, d: str) -> DataFrame:
    """The printed form of the most requested pages, the share in hundredths."""
    top = jobs.top_pages_share(_status_lines(spark, d), TOP_KEYS)
    return format_share_lines(top.withColumn("share", F.floor(F.col("share") * 100)), "page")


def q_printed_top_words(spark: SparkSession, d: str) -> DataFrame:
    """The printed ranking of the words of all documents, read as text lines."""
    lines = _lines(spark, documents(spark, d).where("text is not null"))
    return format_ranked(jobs.line_top_words(lines, TOP_WORDS))


def q_completed_line_count(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the finished ones of several folders: all orders by status, the write of one (P) left unfinished."""
    root, orders = scratch(spark), table(spark, d, "orders")
    line, status = _one_line("o_orderkey", "o_orderpriority"), F.col("o_orderstatus")
    orders.where(status == "F").select(line).write.text(f"{root}/F")
    orders.where(~status.eqNullSafe("F") & ~status.eqNullSafe("P")).select(line).write.text(f"{root}/rest")
    (orders.where(status == "P").select(line)
     .write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").text(f"{root}/P"))
    return jobs.completed_line_count(spark, root)


# ---- the supervisor's state as streams -------------------------------------------------

def _as_it_arrives(spark: SparkSession, events: DataFrame, closing: list[tuple], stream) -> DataFrame:
    """What a stream has appended once all ``events`` have come, a quarter of their time span after the other.

    Spark writes each quarter into the folder that the stream reads; the
    stream is started again after each and goes on from its checkpoint.
    ``closing`` rows (key, outcome) two days later move the watermark on.
    """
    root, ts = scratch(spark), F.col("ts")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    if last is None:
        return run_append_stream(stream(events.limit(0)), f"{root}/sink", f"{root}/checkpoint")
    cuts = [first + (last - first) * i / ARRIVALS for i in range(1, ARRIVALS)]
    slot = F.lit(0)
    for cut in cuts:
        slot = slot + F.when(ts >= F.lit(cut).cast("timestamp_ntz"), 1).otherwise(0)
    end = spark.createDataFrame([(None, key, last + dt.timedelta(days=2), kind) for key, kind in closing], events.schema)
    parts = [events.where(slot == i) for i in range(ARRIVALS)] + [end.coalesce(1)]
    for part in parts:
        part.write.mode("append").parquet(f"{root}/source")
        source = read_stream(spark, f"{root}/source", events.schema)
        out = run_append_stream(stream(source), f"{root}/sink", f"{root}/checkpoint")
    return out


def q_ttl_exclude_stream(spark: SparkSession, d: str) -> DataFrame:
    """``ttl_exclude`` live: a stream of views, let through where no error of their user covers them."""
    def stream(events: DataFrame) -> DataFrame:
        views = events.where(F.col("event_type") == "view").select("event_id", "user_id", "ts")
        errors = events.where(F.col("event_type") == "error").select("user_id", "ts")
        return ttl_exclude_stream_df(views, errors, "user_id", "ts", ttl_hours=3).select("event_id", "user_id")
    events = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    # the closing view is covered by the closing error
    return _as_it_arrives(spark, events, [(-1, "view"), (-1, "error")], stream)


def q_failure_streak_stream(spark: SparkSession, d: str) -> DataFrame:
    """``failure_streak_health`` live."""
    def stream(events: DataFrame) -> DataFrame:
        return failure_streak_stream_df(events, "user_id", "ts", F.col("event_type").isin("error", "click"),
                                        order_by=["event_id"], cap=CAP, keep=["event_id"],
                                        healthy=F.pmod(F.col("event_id"), F.lit(3)) != 0)
    return _as_it_arrives(spark, _events_with_gaps(spark, d), [(None, None)], stream)


def q_trailing_topn_series(spark: SparkSession, d: str) -> DataFrame:
    """The average of the ten largest values of the last twelve hours, as of every event."""
    return trailing_topn_series(table(spark, d, "events"), "event_type", "value", "ts", hours=12, n=10,
                                order_by=["event_id"], keep=["event_id"], digits=ROUND_DIGITS)


def q_word_topk_stream(spark: SparkSession, d: str) -> DataFrame:
    """The ranked words, maintained while the documents come file by file."""
    root, docs = scratch(spark), documents(spark, d)
    docs.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(ARRIVALS))).write.partitionBy("part").parquet(f"{root}/source")
    files = spark.read.parquet(f"{root}/source").inputFiles()
    return run_word_topk_stream(spark, f"{root}/source", root, TOP_WORDS, fmt="parquet", text_col="text",
                                schema=docs.schema, max_files_per_trigger=max(1, len(files) // ARRIVALS))


def q_incremental_line_count(spark: SparkSession, d: str) -> DataFrame:
    """Lines per day of a tree of day folders that grows, counted run by run; one write is not finished until later."""
    root, ev = scratch(spark), table(spark, d, "events")
    line = _one_line("event_id", "event_type", "value").alias("value")
    slot = F.pmod(F.col("event_id"), F.lit(ARRIVALS))

    def count(lines: DataFrame) -> DataFrame:
        return lines.groupBy("date").agg(F.count(F.lit(1)).alias("n_lines"))

    def arrive(n: int, finished: bool) -> None:
        part = ev.where(slot == n).select(F.to_date("ts").alias("day"), line)
        writer = part.write.mode("overwrite").partitionBy("day")
        if not finished:
            writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        writer.text(f"{root}/tree/arrival-{n}")

    for n in range(ARRIVALS):
        arrive(n, n != 1)
        if n == ARRIVALS - 1:
            arrive(1, True)  # written again, and finished now
        run_incremental(spark, f"{root}/tree", f"{root}/out", count, with_date=True)
    out = read_incremental(spark, f"{root}/out", "date date, n_lines bigint")
    return out.groupBy("date").agg(F.sum("n_lines").alias("n_lines")).select(F.col("date").alias("day"), "n_lines")


def q_affected_by_range(spark: SparkSession, d: str) -> DataFrame:
    """Share of addresses with a pending order among those with any, over each quarter of a year and all of them so far.

    Sets per day are written once; every range is counted from them.
    """
    orders = table(spark, d, "orders").select("o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"))
    customers = table(spark, d, "customer").select("c_custkey", "c_name")
    ids = dense_ids(customers, "c_name")
    rows = orders.join(customers.join(ids, "c_name").select(F.col("c_custkey").alias("o_custkey"), "id"), "o_custkey")
    root = scratch(spark)
    (daily_sets(rows, "day", "id", {"affected": F.col("o_orderstatus") == "P", "total": F.lit(True)})
     .repartitionByRange("day").sortWithinPartitions("day").write.parquet(root))  # a range reads its days' row groups
    sets = spark.read.schema("day date, name string, bucket bigint, bits binary").parquet(root)
    first, last = orders.agg(F.min("day"), F.max("day")).first()
    if first is None:
        return affected_over_ranges(sets, "day", [])
    starts = [dt.date(y, m, 1) for y in range(first.year, last.year + 1) for m in (1, 4, 7, 10)]
    ends = [dt.date(s.year + (s.month + 2) // 12, (s.month + 2) % 12 + 1, 1) - dt.timedelta(days=1) for s in starts]
    return affected_over_ranges(sets, "day", [*zip(starts, ends), *[(starts[0], e) for e in ends[1:]]])


def q_choices_over_time(spark: SparkSession, d: str) -> DataFrame:
    """The choice of ``cheapest_under_limit`` as of every signup; users with an error within three hours are out."""
    ev = table(spark, d, "events")
    errors = ev.where(F.col("event_type") == "error").select("user_id", "ts")
    return choices_over_time(ev, ev.where(F.col("event_type") == "signup"), PREFERENCES, "event_type", "user_id",
                             "value", "ts", ["event_id"], exclusions=errors, digits=ROUND_DIGITS)


def q_word_count_stream(spark: SparkSession, d: str) -> DataFrame:
    """The documents table read as a file stream and counted by the stream."""
    root = scratch(spark)
    docs = table(spark, d, "documents")
    # a table written by Spark is a folder of part files: stream that folder;
    # a single file is picked out of the data folder by name
    path = os.path.join(d, "documents.parquet")
    if is_directory(spark, path):
        source, options = path, {}
    else:
        source, options = d, {"pathGlobFilter": "documents.parquet"}
    return run_word_count_stream(
        spark, source, f"{root}/sink", f"{root}/checkpoint", fmt="parquet", text_col="text",
        schema=docs.schema, options=options)


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "line_count": q_line_count,
    "dated_line_count": q_dated_line_count,
    "word_count": q_word_count,
    "word_count_topk": q_word_count_topk,
    "value_share": q_value_share,
    "affected_share": q_affected_share,
    "topk_share": q_topk_share,
    "anagram_groups": q_anagram_groups,
    "pair_digest_match": q_pair_digest_match,
    "option_expand": q_option_expand,
    "trailing_topn_avg": q_trailing_topn_avg,
    "cheapest_under_limit": q_cheapest_under_limit,
    "choice_severity": q_choice_severity,
    "ttl_exclude": q_ttl_exclude,
    "failure_streak": q_failure_streak,
    "word_count_stream": q_word_count_stream,
    "anagram_members": q_anagram_members,
    "cheapest_without_limit": q_cheapest_without_limit,
    "failure_streak_health": q_failure_streak_health,
    "status_share": q_status_share,
    "affected_ip_share": q_affected_ip_share,
    "top_pages_share": q_top_pages_share,
    "top_pages_lines": q_top_pages_lines,
    "printed_top_words": q_printed_top_words,
    "completed_line_count": q_completed_line_count,
    "word_rank": q_word_rank,
    "key_rank": q_key_rank,
    "ttl_exclude_stream": q_ttl_exclude_stream,
    "failure_streak_stream": q_failure_streak_stream,
    "trailing_topn_series": q_trailing_topn_series,
    "choices_over_time": q_choices_over_time,
    "word_topk_stream": q_word_topk_stream,
    "incremental_line_count": q_incremental_line_count,
    "affected_by_range": q_affected_by_range,
}
