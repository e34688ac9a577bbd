"""Pair digest match, time-limited exclusion, option expansion."""

import datetime as dt
import hashlib
import itertools
import random

from conftest import rows
from tessera.operators import option_expand, pair_digest_match, ttl_exclude

# Neutral key values in the shape of the credential fixture: three names and
# four secrets, each list ending with a line of four spaces, and five
# digests (one of them of a real pair, the last line blank).
NAMES = ["alpha", "bravo", "charlie", "    "]
SECRETS = ["111111", "2222222", "33333333", "xyzzy", "    "]


def md5(s):
    return hashlib.md5(s.encode("utf-8")).hexdigest()


DIGESTS = [md5("zulu:000"), md5("bravo:xyzzy"), md5("alpha:nope"), "f" * 32, "    "]


def test_pair_digest_fixture_one_match(spark):
    pairs = spark.createDataFrame(list(itertools.product(NAMES, SECRETS)), "a string, b string")
    digests = spark.createDataFrame([(d,) for d in DIGESTS], "digest string")
    got = rows(pair_digest_match(pairs, digests, "a", "b"))
    assert got == [("bravo", "xyzzy", md5("bravo:xyzzy"))]


def test_pair_digest_duplicates_and_nulls(spark):
    pairs = spark.createDataFrame([("a", "b"), ("a", "b"), (None, "b"), ("a", None)], "a string, b string")
    digests = spark.createDataFrame([(md5("a:b"),), (md5("a:b"),), (None,)], "digest string")
    got = rows(pair_digest_match(pairs, digests, "a", "b"))
    assert got == [("a", "b", md5("a:b"))] * 2


def test_pair_digest_non_ascii_is_utf8(spark):
    pairs = spark.createDataFrame([("josé", "ñ")], "a string, b string")
    digests = spark.createDataFrame([(md5("josé:ñ"),)], "digest string")
    assert pair_digest_match(pairs, digests, "a", "b").count() == 1


T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def h(x):
    return T0 + dt.timedelta(hours=x)


def test_ttl_exclude_boundaries(spark):
    cands = [(1, "u", h(1)), (2, "u", h(4)), (3, "u", h(3.999)), (4, "v", h(1)),
             (5, "u", h(0.5)), (6, None, h(1)), (7, "u", None), (8, "w", h(10))]
    excl = [("u", h(1)), ("v", h(1.0001)), (None, h(1)), ("w", h(7.0001))]
    c = spark.createDataFrame(cands, "id int, k string, ts timestamp_ntz")
    e = spark.createDataFrame(excl, "k string, ts timestamp_ntz")
    got = sorted(r.id for r in ttl_exclude(c, e, "k", "ts", 3).collect())
    # 1: excluded at equal time; 2: exactly ttl later, alive; 3: just inside;
    # 4: exclusion after it; 5: before it; 6/7: null key/time; 8: 2.9999 h later.
    assert got == [2, 4, 5, 6, 7]


def brute_ttl(cands, excl, ttl):
    out = []
    for cid, k, t in cands:
        hit = any(ek == k and k is not None and t is not None and et <= t < et + ttl
                  for ek, et in excl)
        if not hit:
            out.append(cid)
    return sorted(out)


def test_ttl_exclude_random_against_brute_force(spark):
    rnd = random.Random(7)
    keys = ["hot"] * 6 + ["a", "b", "c"]
    cands = [(i, rnd.choice(keys), h(rnd.uniform(0, 40))) for i in range(400)]
    excl = [(rnd.choice(keys), h(rnd.uniform(0, 40))) for _ in range(60)]
    c = spark.createDataFrame(cands, "id int, k string, ts timestamp_ntz")
    e = spark.createDataFrame(excl, "k string, ts timestamp_ntz")
    for ttl in (0.5, 3, 7.25):
        got = sorted(r.id for r in ttl_exclude(c, e, "k", "ts", ttl).collect())
        assert got == brute_ttl(cands, excl, dt.timedelta(hours=ttl)), ttl


def test_ttl_exclude_keeps_candidate_columns(spark):
    c = spark.createDataFrame([(1, "u", h(1), 2.5)], "id int, k string, ts timestamp_ntz, v double")
    e = spark.createDataFrame([], "k string, ts timestamp_ntz")
    out = ttl_exclude(c, e, "k", "ts")
    assert out.columns == ["id", "k", "ts", "v"] and out.count() == 1


def test_option_expand_list_and_array(spark):
    regions = spark.createDataFrame([("east-1", ["a", "b"]), ("west-2", []), (None, ["a"])],
                                    "region string, suffixes array<string>")
    got = rows(option_expand(regions, "region", "suffixes"))
    assert got == [("east-1", "east-1a"), ("east-1", "east-1b")]
    got = rows(option_expand(regions, "region", ["a", "c", "e"], sep="-"))
    assert [z for _, z in got] == ["east-1-a", "east-1-c", "east-1-e", "west-2-a", "west-2-c", "west-2-e"]
