"""Streams of the supervisor's state: equal to the batch jobs, over batches, restarts and late rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import failure_streak, ttl_exclude
from tessera.streaming import failure_streak_stream_df, read_stream, run_append_stream, start_append_stream, ttl_exclude_stream_df
from tessera.streaming.failures import advance

NOW = dt.datetime(2024, 5, 1)
SCHEMA = "event_id long, user_id long, ts timestamp_ntz, kind string"


def made(n, seed, keys=4, hours=30):
    rng = random.Random(seed)
    return [(i, rng.choice([None, *range(keys)]), NOW + dt.timedelta(seconds=rng.randrange(hours * 3600), microseconds=rng.choice([0, 0, 7])),
             rng.choice(["view", "view", "error", "none"])) for i in range(n)]


def arrive(spark, folder, data):
    """One more file."""
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def close(data, days=9):
    """Rows that move the watermark beyond all others."""
    late = max(r[2] for r in data if r[2]) + dt.timedelta(days=days)
    return [(-1, None, late, "none"), (-2, 0, late, "view"), (-3, 0, late, "error")]


def kinds(df):
    return df.where("kind = 'view'"), df.where("kind = 'error'").select("user_id", "ts")


def exclude(spark, src, sink, ck, **kw):
    cand, exc = kinds(read_stream(spark, src, SCHEMA, 1))
    return run_append_stream(ttl_exclude_stream_df(cand, exc, "user_id", "ts", **kw), sink, ck)


def real(df):
    return sorted(r.event_id for r in df.collect() if r.event_id >= 0)


@pytest.mark.parametrize("zoned", [False, True])
def test_exclusions_equal_the_batch_job_over_restarts(spark, scratch, zoned):
    data = sorted(made(400, 1), key=lambda r: r[2])
    data += [(900, 1, None, "view"), (901, None, None, "view"), (902, 1, None, "error"), (903, 2, data[5][2], "view"),
             (903, 2, data[5][2], "view")]
    src, sink, ck = f"{scratch}/src", f"{scratch}/sink", f"{scratch}/ck"
    schema = SCHEMA.replace("timestamp_ntz", "timestamp") if zoned else SCHEMA
    batch = spark.createDataFrame(data, schema)
    want = real(ttl_exclude(*kinds(batch), "user_id", "ts", ttl_hours=2))

    def run():
        cand, exc = kinds(read_stream(spark, src, schema, 1))
        return run_append_stream(ttl_exclude_stream_df(cand, exc, "user_id", "ts", ttl_hours=2, delay="30 hours"), sink, ck)

    rng = random.Random(2)
    rng.shuffle(data)  # out of order over the whole span, as the delay allows
    for part in (data[:150], data[150:]):  # two runs: the second goes on from the checkpoint
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        run()
    spark.createDataFrame(close(data), schema).coalesce(1).write.mode("append").parquet(src)
    assert real(run()) == want and len(want) < len(data)
    assert real(run()) == want  # nothing new, nothing twice


def test_rows_beyond_the_delay_call_nothing_back(spark, scratch):
    t = lambda h: NOW + dt.timedelta(hours=h)
    src, sink, ck = f"{scratch}/src", f"{scratch}/sink", f"{scratch}/ck"
    arrive(spark, src, [(1, 1, t(1), "view"), (2, 1, t(9), "error"), (3, 1, t(20), "view")])
    exclude(spark, src, sink, ck, ttl_hours=3, delay="1 hour")
    arrive(spark, src, [(4, 1, t(0.9), "error"), (5, 1, t(19.5), "error")])  # one too late, one within the delay
    exclude(spark, src, sink, ck, ttl_hours=3, delay="1 hour")
    arrive(spark, src, close([(0, 0, t(20), "")]))
    assert real(exclude(spark, src, sink, ck, ttl_hours=3, delay="1 hour")) == [1]


def test_many_exclusions_of_a_key_join_as_few_rows(spark, scratch):
    data = [(i, 1, NOW + dt.timedelta(seconds=i), "error" if i % 2 else "view") for i in range(3000)]
    src = f"{scratch}/src"
    arrive(spark, src, data)
    arrive(spark, src, close(data))
    cand, exc = kinds(read_stream(spark, src, SCHEMA, 1))
    out = ttl_exclude_stream_df(cand, exc, "user_id", "ts", ttl_hours=3)
    assert real(run_append_stream(out, f"{scratch}/sink", f"{scratch}/ck")) == [0]


@pytest.mark.parametrize("cap,health", [(2, True), (None, False)])
def test_streaks_equal_the_batch_job(spark, scratch, cap, health):
    data = sorted(made(300, 5 + (cap or 0)), key=lambda r: r[2])
    failed = F.when(F.col("kind") != "none", F.col("kind") == "error")
    args = dict(key="user_id", ts="ts", failed=failed, order_by=["event_id"], cap=cap, keep=["event_id"],
                healthy=(F.pmod(F.col("event_id"), F.lit(3)) != 0) if health else None)
    want = rows(failure_streak(spark.createDataFrame([(999, 1, None, "error"), *data], SCHEMA), **args))
    src, sink, ck = f"{scratch}/src", f"{scratch}/sink", f"{scratch}/ck"
    rng, cuts = random.Random(6), [0, 70, 140, 300]
    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):  # batches split streaks; each is shuffled
        part = data[a:b] + ([(999, 1, None, "error")] if not a else [])
        if n == 1 and a:  # one row comes a batch later than its neighbours, within the delay
            part, late = part[1:], part[:1]
        elif n == 2:
            part = part + late
        rng.shuffle(part)
        arrive(spark, src, part)
        stream = read_stream(spark, src, SCHEMA, 1)
        run_append_stream(failure_streak_stream_df(stream, delay="20 hours", **args), sink, ck)
    arrive(spark, src, [(-1, None, close(data)[0][2], "none")])
    out = run_append_stream(failure_streak_stream_df(read_stream(spark, src, SCHEMA, 1), delay="20 hours", **args), sink, ck)
    # null user -1 marks the end and fails nothing
    assert rows(out) == want


@pytest.mark.parametrize("kind", ["bigint", "string", "double"])
def test_many_keys_share_a_bucket(spark, scratch, kind):
    """State and calls follow the buckets, not the keys; large numbers beside nulls stay as they are."""
    big = 1 << 60
    data = [(big + i if i % 5 else None, u, t, k) for i, u, t, k in sorted(made(400, 9, keys=60), key=lambda r: r[2])]
    data += [(big + 1000, 3, None, "error"), (None, None, None, "error")]

    def shaped(df):
        user = {"double": "if(user_id = 2 and event_id % 2 = 0, -0.0D, user_id - 2)",
                "bigint": f"user_id + {big}", "string": "concat('user ', user_id)"}[kind]
        return df.selectExpr("event_id", f"cast({user} as {kind}) as user_id", "ts", "kind", "concat(event_id, user_id) as more")

    args = dict(key="user_id", ts="ts", failed=F.col("kind").isin("error", "view"), order_by=["event_id", "more"], cap=2,
                keep=["event_id", "more"], healthy=F.col("kind") == "view")
    groups = {}
    for r in shaped(spark.createDataFrame(data, SCHEMA)).collect():
        groups.setdefault(repr(r.user_id).replace("-0.0", "0.0"), []).append(r)
    want = []
    for group in groups.values():
        group.sort(key=lambda r: (r.ts or dt.datetime.min, r.event_id or -1, r.more or ""))
        streaks, _ = advance([r.kind in ("error", "view") for r in group], [r.kind == "view" for r in group], 0, 2)
        failures = [r for r in group if r.kind in ("error", "view")]
        want += [(r.event_id, r.more, r.user_id, n) for r, n in zip(failures, streaks, strict=True)]
    src, sink, ck = f"{scratch}/src", f"{scratch}/sink", f"{scratch}/ck"
    end = [(-1, None, close(data)[0][2], "none")]
    for part in (data[:200], data[200:], end):
        arrive(spark, src, part)
        out = failure_streak_stream_df(shaped(read_stream(spark, src, SCHEMA, 1)), delay="20 hours", buckets=3, **args)
        query = start_append_stream(out, sink, ck)
        query.awaitTermination()
        assert all(p["stateOperators"][0]["numRowsTotal"] <= 3 for p in query.recentProgress)
    got = spark.read.schema(out.schema).parquet(sink).select("event_id", "more", "user_id", "streak").collect()
    assert sorted(repr(tuple(r)) for r in got) == sorted(map(repr, want))


def test_exclusions_are_kept_for_the_parts_of_time_they_reach(spark, scratch):
    n, src = 200, f"{scratch}/src"
    arrive(spark, src, [(i, i, NOW + dt.timedelta(minutes=i % 180), "error") for i in range(n)])
    arrive(spark, src, [(n + i, i, NOW + dt.timedelta(hours=5), "view") for i in (0, 150, n)])
    arrive(spark, src, [(n + n, 0, NOW + dt.timedelta(hours=5.2), "view")])  # moves the watermark on, but not past any reach
    arrive(spark, src, close([(0, 0, NOW, "")]))
    cand, exc = kinds(read_stream(spark, src, SCHEMA, 1))
    query = start_append_stream(ttl_exclude_stream_df(cand, exc, "user_id", "ts", ttl_hours=3), f"{scratch}/sink", f"{scratch}/ck")
    query.awaitTermination()
    held = [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"] if "Join" in op["operatorName"]]
    assert 0 < max(held) <= 3 * n + 4
    assert real(spark.read.parquet(f"{scratch}/sink")) == [n, n + n, n + n]
