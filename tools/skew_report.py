"""Hot-key report: how the per-key sequence jobs spread a key with a third of all rows.

Derives a skewed events table from the given ``events`` table with Spark
(copies shifted in time; every third copy's rows all belong to one user),
runs ``failure_streak``, ``ttl_exclude`` and ``trailing_topn_avg`` and,
for comparison, a plain window partitioned by user alone, and reads the per-task shuffle records of
each run from Spark's event log (written to a scratch folder).

Usage: python tools/skew_report.py [sf_dir] [copies]
Prints one JSON line per run (timed after one warm-up run): total rows, the
hot user's rows, and the largest number of shuffle records read by one task.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def skewed_events(spark, sf_dir: str, copies: int):
    from tessera.sources import table
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    n = ev.count()
    c = spark.range(copies).withColumnRenamed("id", "copy")
    out = ev.join(c.hint("broadcast"), how="inner")  # fixed, tiny copy list
    return out.select(
        (F.col("copy") * F.lit(n) + F.col("event_id")).alias("event_id"),
        (F.col("ts") + F.make_dt_interval(F.col("copy") * 31)).alias("ts"),
        F.when(F.col("copy") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")).alias("user_id"),
        "event_type")


def bursty_events(spark, sf_dir: str, copies: int):
    """Like ``skewed_events``, but the hot user's rows fall within two hours, a third of them
    at one instant and a few without a time."""
    ev = skewed_events(spark, sf_dir, copies)
    hot, i = F.col("user_id") == -1, F.pmod(F.xxhash64("event_id"), F.lit(9))
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    spread = start + F.make_dt_interval(secs=F.pmod(F.xxhash64(F.lit(1), "event_id"), F.lit(7200)))
    ts = F.when(hot & (i == 0), F.lit(None)).when(hot & (i < 4), start).when(hot, spread).otherwise(F.col("ts"))
    return ev.withColumn("ts", ts.cast("timestamp_ntz"))


def task_records(log_dir: str, after_job: int) -> list[int]:
    """Shuffle records read per task for jobs started after ``after_job``."""
    files = sorted(f for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
                   if os.path.isfile(f) and "appstatus" not in os.path.basename(f))
    recs, stage_of_job, jobs = [], {}, set()
    for f in files:
        with open(f) as fh:
            for line in fh:
                e = json.loads(line)
                ev = e.get("Event")
                if ev == "SparkListenerJobStart" and e["Job ID"] > after_job:
                    jobs.add(e["Job ID"])
                    for s in e.get("Stage IDs", []):
                        stage_of_job[s] = e["Job ID"]
                elif ev == "SparkListenerTaskEnd" and stage_of_job.get(e.get("Stage ID")) in jobs:
                    m = e.get("Task Metrics") or {}
                    r = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    recs.append(r)
    return recs


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 9
    log_dir = tempfile.mkdtemp(prefix="tessera-eventlog-")
    from tessera.session import build_session
    from tessera.operators import failure_streak, trailing_topn_avg, ttl_exclude
    spark = build_session("local[8]", shuffle_partitions=32,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.compress": "false", "spark.driver.memory": "8g",
                                 "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    ev = skewed_events(spark, sf_dir, copies)
    total = ev.count()
    hot = ev.where(F.col("user_id") == -1).count()
    err = F.col("event_type") == "error"
    burst = bursty_events(spark, sf_dir, copies)

    def streak(df):
        return failure_streak(df, "user_id", "ts", err, order_by=["event_id"], cap=2, keep=["event_id"])

    def exclude(df):
        return ttl_exclude(df.where(F.col("event_type") != "error"), df.where(err).select("user_id", "ts"),
                           "user_id", "ts", 3.0)

    runs = {
        "failure_streak (chunks)": lambda: streak(ev),
        "ttl_exclude (chunks)": lambda: exclude(ev),
        "failure_streak_burst (hot key within two hours)": lambda: streak(burst),
        "ttl_exclude_burst (hot key within two hours)": lambda: exclude(burst),
        "trailing_topn_avg (top 10 per user, whole history)": lambda: trailing_topn_avg(
            ev.withColumn("v", F.col("event_id") % 997), "user_id", "v", "ts",
            hours=24 * 31 * copies, n=10),
        "plain window by key (for comparison)": lambda: ev.withColumn(
            "rn", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))),
    }
    tracker = spark.sparkContext.statusTracker()
    ev, burst = ev.persist(), burst.persist()  # the derived inputs are the same for every run
    ev.count(), burst.count()
    for name, build in runs.items():
        build().write.format("noop").mode("overwrite").save()  # warm-up (codegen, JIT)
        time.sleep(1.0)
        before = max(tracker.getJobIdsForGroup(None) or [-1])
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        secs = time.perf_counter() - t0
        time.sleep(1.0)  # let the event log flush
        recs = task_records(log_dir, before)
        print(json.dumps({"run": name, "rows": total, "hot_user_rows": hot,
                          "max_records_per_task": max(recs) if recs else 0,
                          "tasks": len(recs), "sec": round(secs, 2)}))
    spark.stop()


if __name__ == "__main__":
    main()
