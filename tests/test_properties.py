"""Property tests: sequence jobs against plain-Python statements of their meaning."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import failure_streak, trailing_topn_avg, ttl_exclude

T0 = dt.datetime(2024, 3, 1)
SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

# times on a coarse grid (quarter hours over two days) so that ties and
# bucket edges are common
times = st.integers(min_value=0, max_value=4 * 48).map(lambda q: T0 + dt.timedelta(minutes=15 * q))
keys = st.sampled_from(["hot", "hot", "hot", "a", "b", None])


@SETTINGS
@given(cands=st.lists(st.tuples(keys, st.one_of(times, st.none())), max_size=40),
       excl=st.lists(st.tuples(keys, times), max_size=15),
       ttl=st.sampled_from([0.25, 1.0, 3.0]))
def test_ttl_exclude_matches_definition(spark, cands, excl, ttl):
    rows_c = [(i, k, t) for i, (k, t) in enumerate(cands)]
    c = spark.createDataFrame(rows_c, "id int, k string, ts timestamp_ntz")
    e = spark.createDataFrame(excl, "k string, ts timestamp_ntz")
    got = sorted(r.id for r in ttl_exclude(c, e, "k", "ts", ttl).collect())
    life = dt.timedelta(hours=ttl)
    want = sorted(i for i, k, t in rows_c
                  if not any(k is not None and t is not None and ek == k and et <= t < et + life
                             for ek, et in excl))
    assert got == want


@SETTINGS
@given(events=st.lists(st.tuples(st.sampled_from(["hot", "hot", "a", "b"]), times,
                                 st.one_of(st.booleans(), st.none())), max_size=50),
       cap=st.sampled_from([None, 1, 2, 3]))
def test_failure_streak_matches_counter(spark, events, cap):
    rows_e = [(i, k, t, f) for i, (k, t, f) in enumerate(events)]
    df = spark.createDataFrame(rows_e, "id int, k string, ts timestamp_ntz, failed boolean")
    out = failure_streak(df, "k", "ts", F.col("failed"), order_by=["id"], cap=cap, keep=["id"])
    got = {r.id: r.streak for r in out.collect()}
    want = {}
    for key in {r[1] for r in rows_e}:
        count = 0
        for i, k, t, f in sorted((r for r in rows_e if r[1] == key), key=lambda r: (r[2], r[0])):
            if f is True:
                count += 1
                want[i] = count
                if cap and count >= cap:
                    count = 0
            elif f is False:
                count = 0
    assert got == want


@SETTINGS
@given(vals=st.lists(st.tuples(st.sampled_from(["x", "y"]), times,
                               st.integers(0, 50).map(float)), min_size=1, max_size=40),
       n=st.integers(1, 4), hours=st.sampled_from([1, 6, 12]))
def test_trailing_topn_avg_matches_definition(spark, vals, n, hours):
    df = spark.createDataFrame(vals, "k string, ts timestamp_ntz, v double")
    as_of = max(t for _, t, _ in vals)
    got = {r.k: r.avg_top for r in trailing_topn_avg(df, "k", "v", "ts", hours=hours, n=n).collect()}
    lo = (as_of - dt.timedelta(hours=hours)).replace(microsecond=0)
    want = {}
    for key in {k for k, _, _ in vals}:
        top = sorted((v for k, t, v in vals if k == key and t >= lo), reverse=True)[:n]
        if top:
            want[key] = sum(top) / len(top)
    assert got.keys() == want.keys()
    for key in got:
        assert abs(got[key] - want[key]) < 1e-9


# text jobs against plain Python on random small texts (Python's ``regex``
# module understands \p{L} like the JVM)
alphabet = st.sampled_from(list("abcAB éÉß'-1 \n.,"))
texts = st.lists(st.text(alphabet=alphabet, max_size=30), max_size=8)


@SETTINGS
@given(lines=texts)
def test_word_count_matches_python(spark, lines):
    import regex

    from tessera.operators import word_count
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = dict(word_count(df).collect())
    want = {}
    for line in lines:
        for w in regex.findall(r"[\p{L}'-]+", line):
            want[w.lower()] = want.get(w.lower(), 0) + 1
    assert got == want


@SETTINGS
@given(lines=texts)
def test_anagram_groups_match_python(spark, lines):
    from tessera.operators import anagram_groups
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = sorted(r.words for r in anagram_groups(df, whole_documents=True).collect())
    groups = {}
    for line in lines:
        for part in line.replace("\n", " ").split(" "):
            groups.setdefault("".join(sorted(part)), set()).add(part)
    want = sorted(" ".join(sorted(ws)) for ws in groups.values() if len(ws) > 1)
    assert got == want
