"""Trailing top-n averages at every event, against plain Python and the job of one instant."""

import datetime as dt
import random

import numpy as np
import pyarrow as pa
import pytest

from tessera.operators import sliding, trailing_topn_avg, trailing_topn_series
from tessera.operators.sequence import begins

NOW = dt.datetime(2024, 5, 1)
SCHEMA = "event_id long, k string, ts timestamp_ntz, value double"


def made(n, seed, keys=("a", "b", None), hours=40, burst=0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        t = NOW + (dt.timedelta(hours=7) if i < burst else
                   dt.timedelta(seconds=rng.randrange(hours * 3600), microseconds=rng.choice([0, 0, 500_000])))
        out.append((i, rng.choice(keys), None if i == n - 1 else t,
                    rng.choice([None, float("nan"), 1.0, round(rng.random() * 100, 3), round(-rng.random(), 3)])))
    return out


def brute(data, hours, n, points=None):
    span = dt.timedelta(hours=hours)
    out = {}
    for i, k, t, _ in (data if points is None else points):
        if t is None:
            out[i] = None
            continue
        low = (t - span).replace(microsecond=0)
        v = [x for j, kk, u, x in data if kk == k and u is not None and low <= u and x is not None and x == x
             and ((u, j) <= (t, i) if points is None else u <= t)]
        best = sorted(v, reverse=True)[:n]
        out[i] = round(sum(best) / len(best), 6) if best else None
    return out


def series(df, **kw):
    got = trailing_topn_series(df, "k", "value", "ts", order_by=["event_id"], keep=["event_id"], digits=6, **kw).collect()
    out = {r.event_id: r.avg_top for r in got}
    assert len(out) == len(got)
    return out


@pytest.mark.parametrize("n", [1, 5, 10, 64])
def test_range_tops(n):
    rng = np.random.default_rng(n)
    v = rng.normal(size=300)
    v[rng.random(300) < 0.2] = -np.inf
    lo = rng.integers(0, 301, 200)
    hi = np.minimum(lo + rng.integers(0, 301, 200), 300)
    hi = np.maximum(lo, hi)
    got = sliding.range_tops(v[:, None], lo, hi, n)
    for a, b, row in zip(lo, hi, got):
        best = np.sort(v[a:b])[-n:]
        assert np.array_equal(row[n - len(best):], best) and np.all(row[: n - len(best)] == -np.inf)


@pytest.mark.parametrize("rows_per_chunk,burst", [(100_000, 0), (60, 0), (25, 150)])
def test_equals_plain_python(spark, monkeypatch, rows_per_chunk, burst):
    monkeypatch.setattr(sliding, "CHUNK_ROWS", rows_per_chunk)
    data = made(500, 4, burst=burst)
    got = series(spark.createDataFrame(data, SCHEMA).repartition(5), hours=9, n=4)
    assert got == brute(data, 9, 4)


def test_at_given_points(spark, monkeypatch):
    monkeypatch.setattr(sliding, "CHUNK_ROWS", 80)
    data, points = made(300, 5), [(1000 + i, k, t, v) for i, k, t, v in made(200, 6, keys=("a", "none", None))]
    points += [(2000 + i, k, t, v) for i, k, t, v in data[:50]]
    got = series(spark.createDataFrame(data, SCHEMA), hours=12.5, n=3,
                 points=spark.createDataFrame(points, SCHEMA).drop("value"))
    assert got == brute(data, 12.5, 3, points)


def test_one_key_over_many_chunks_and_long_windows(spark, monkeypatch):
    monkeypatch.setattr(sliding, "CHUNK_ROWS", 40)
    data = [(i, "hot", NOW + dt.timedelta(seconds=i), float(400 - i)) for i in range(400)]  # falling: old values stay on top
    assert series(spark.createDataFrame(data, SCHEMA), hours=0.05, n=7) == brute(data, 0.05, 7)


def test_last_event_agrees_with_the_job_of_one_instant(spark):
    data = [r for r in made(300, 7, keys=("a",)) if r[2] is not None and r[3] == r[3]]
    df = spark.createDataFrame(data, SCHEMA)
    last = max(data, key=lambda r: (r[2], r[0]))
    (want,) = trailing_topn_avg(df, "k", "value", "ts", hours=12, n=10, digits=6).collect()
    assert series(df)[last[0]] == want.avg_top


def test_no_events(spark):
    assert series(spark.createDataFrame([], SCHEMA)) == {}


def test_lists_are_kept_for_windows_that_go_on_alone(spark, monkeypatch):
    folders, scratch = [], sliding.scratch
    monkeypatch.setattr(sliding, "scratch", lambda s: folders.append(scratch(s)) or folders[-1])
    data = made(80, 3, keys=(None, *"abcdefgh"))
    assert series(spark.createDataFrame(data, SCHEMA).repartition(1), hours=3, n=4) == brute(data, 3, 4)
    rows = spark.read.parquet(folders[0]).collect()  # few rows: one chunk
    assert all(len(r["__tops"]) == 0 for r in rows if r["__closed"] and r["__kind"] == sliding.EVENT)
    assert {r.k for r in rows if r["__kind"] == sliding.MARK} == {"h"}


def test_rows_of_a_new_key():
    nan = float("nan")
    table = pa.table({"a": pa.chunked_array([[None, None, nan], [nan, 0.0, -0.0, 1.0]]), "b": list("xxxxxyy"),
                      "c": pa.array([[1], [1], [1], [1], [1], [1], None])})
    assert begins(table, ["a"]).tolist() == [True, False, True, False, True, False, True]
    assert begins(table, ["a", "b"]).tolist() == [True, False, True, False, True, True, True]
    assert begins(table, ["c"]).tolist() == [True] + [False] * 5 + [True]
    assert begins(table.slice(0, 0), ["a"]).tolist() == []
