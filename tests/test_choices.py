"""Choices at many instants: each equal to the job of one instant, and to plain Python."""

import datetime as dt
import random

import pytest

from tessera.operators import cheapest_under_limit, choices, choices_over_time

NOW = dt.datetime(2024, 5, 1)
PRICES = "grp string, opt long, ts timestamp_ntz, value double"
PREFS = [(1, "a", 6.0), (2, "b", 20.0), (4, "c", 400.0)]


def made(n, seed, hours=48, groups=("a", "b", "c", "d"), opts=6):
    rng = random.Random(seed)
    return [(rng.choice(groups), rng.choice([None, *range(opts)]),
             NOW + dt.timedelta(seconds=rng.randrange(hours * 3600), microseconds=rng.choice([0, 250_000])),
             rng.choice([None, round(rng.random() * 90, 2), round(rng.random() * 9, 2), -1.0])) for _ in range(n)]


def brute(data, gone, t):
    def avg_top(rows, hours, n):
        low = (t - dt.timedelta(hours=hours)).replace(microsecond=0)
        best = sorted((v for at, v in rows if low <= at <= t and v is not None), reverse=True)[:n]
        return sum(best) / len(best) if best else 0.0
    for pos, g, limit in PREFS:
        options = {}
        for grp, o, at, v in data:
            if grp == g:
                options.setdefault(o, []).append((at, v))
        for _, o2 in [(x, y) for x, y in gone if x <= t < x + dt.timedelta(hours=3)]:
            options.pop(o2, None)
        found = [(max(avg_top(r, 12, 10), avg_top(r, 6, 2)), o is not None, o or 0, o) for o, r in options.items()]
        found = sorted(x for x in found if x[0] > 0)
        if found and found[0][0] < limit * 0.8:
            return (pos, g, found[0][3], round(found[0][0], 6))
    return (None, None, None, None)


@pytest.mark.parametrize("chunk,seed", [(60, 2)])
def test_equals_plain_python(spark, monkeypatch, chunk, seed):
    monkeypatch.setattr(choices, "CHUNK_ROWS", chunk)
    monkeypatch.setattr("tessera.operators.sliding.CHUNK_ROWS", chunk)
    monkeypatch.setattr("tessera.operators.sequence.LEAST_ROWS", chunk)
    data, rng = made(260, seed), random.Random(seed)
    times = [(i, NOW + dt.timedelta(seconds=rng.randrange(60 * 3600))) for i in range(120)] + [(998, data[3][2]), (999, None)]
    gone = [(NOW + dt.timedelta(hours=rng.randrange(50)), rng.choice([None, 1, 2, 3])) for _ in range(12)]
    got = choices_over_time(
        spark.createDataFrame(data, PRICES), spark.createDataFrame(times, "id long, ts timestamp_ntz"), PREFS, "grp", "opt",
        "value", "ts", ["id"], exclusions=spark.createDataFrame([(o, t) for t, o in gone], "opt long, ts timestamp_ntz"),
        digits=6)
    want = {i: brute(data, gone, t) if t else (None,) * 4 for i, t in times}
    assert {r.id: (r.pos, r.grp, r.opt, r.price) for r in got.collect()} == want
    assert len({w[0] for w in want.values()}) > 2


def test_a_choice_is_that_of_the_job_of_one_instant(spark):
    data = made(150, 9)
    prices = spark.createDataFrame(data, PRICES)
    prefs = spark.createDataFrame(PREFS, "pos int, grp string, max_price double")
    t = NOW + dt.timedelta(hours=30, microseconds=5)
    (one,) = cheapest_under_limit(prices, prefs, "grp", "opt", "value", "ts", as_of=t).collect()
    (got,) = choices_over_time(prices, spark.createDataFrame([(1, t)], "id long, ts timestamp_ntz"), PREFS, "grp", "opt",
                               "value", "ts", ["id"]).collect()
    assert (got.pos, got.grp, got.opt) == (one.pos, one.grp, one.opt) and abs(got.price - one.price) < 1e-9


def test_no_prices_and_no_decisions(spark):
    prices, none = spark.createDataFrame([], PRICES), spark.createDataFrame([], "id long, ts timestamp_ntz")
    some = spark.createDataFrame([(1, NOW)], "id long, ts timestamp_ntz")
    args = (PREFS, "grp", "opt", "value", "ts", ["id"])
    assert [tuple(r) for r in choices_over_time(prices, some, *args).collect()] == [(1, None, None, None, None)]
    assert choices_over_time(spark.createDataFrame(made(9, 1), PRICES), none, *args).collect() == []
    with pytest.raises(ValueError):
        choices_over_time(prices, some, [(1, "a", None)], "grp", "opt", "value", "ts", ["id"])


def test_averages_are_asked_for_where_nothing_is_excluded(spark, monkeypatch):
    asked, series = [], choices.trailing_topn_series

    def counted(*args, points, **kw):
        asked.append({(r.key, r.at) for r in points.collect()})
        return series(*args, points=points, **kw)

    monkeypatch.setattr(choices, "trailing_topn_series", counted)
    hour = lambda h: NOW + dt.timedelta(hours=h)
    prices = spark.createDataFrame([("a", 1, hour(0), 2.0), ("a", 1, hour(2), 8.0), ("a", None, hour(2), 4.0)], PRICES)
    gone = spark.createDataFrame([(1, hour(1)), (None, hour(7))], "opt long, ts timestamp_ntz")
    steps = choices.price_steps(prices, "grp", "opt", "value", "ts", exclusions=gone).collect()
    at = {h: int((hour(h) - dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000 for h in (0, 1, 2, 4, 7, 10)}
    got = {(r.opt, r.at): r.price for r in steps}
    assert len(got) == len(steps)
    want = {(1, 0): 2.0, (1, 1): 0.0, (1, 2): 0.0, (1, 4): 5.0, (None, 2): 4.0, (None, 7): 0.0, (None, 10): 4.0}
    assert {(o, h): got[o, at[h]] for o, h in want} == want
    assert len(asked) == 2 and all(len(a) < len(steps) for a in asked)
    assert not any(t in (at[1], at[2]) and '"opt":1' in key for a in asked for key, t in a)


def test_linked_steps_follow_on_from_earlier_chunks(spark, monkeypatch):
    monkeypatch.setattr(choices, "STEP_ROWS", 7)
    monkeypatch.setattr("tessera.operators.sequence.LEAST_ROWS", 7)
    rng = random.Random(4)
    steps = [(g, o, at, float(rng.randrange(5)), at // 10) for g, o, n in
             [("a", 1, 30), ("a", None, 3), (None, 2, 11), ("b", 1, 1), (None, None, 25)] for at in rng.sample(range(90), n)]
    want = {}
    for g, o, at, price, b in sorted(steps, key=lambda s: s[2]):
        want.setdefault((g, o), []).append((at, price, b))
    want = {(g, o, r[0]): (b[1], b[2]) if b else (None, None)
            for (g, o), rs in want.items() for b, r in zip([None, *rs], rs)}
    df = spark.createDataFrame(steps, "grp string, opt long, at long, price double, __b long")
    got = choices._with_previous(df, "grp", "opt").collect()
    assert len(got) == len(steps)
    assert {(r.grp, r.opt, r.at): (r["__was"], r["__since"]) for r in got} == want
