"""The prefix trie of conversations against a plain dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import conversations as C
from tessera.llm import zfast_trie

SCHEMA = ("conv_id long, turn long, role string, text string, s long, d long, x1 long, total long, rep long, len long, "
          "k long, points long")


def turn(c, t, role, text):
    """A row with extra columns whose names the operator uses inside."""
    return (c, t, role, text, 7, 7, 7, 7, 7, 7, 7, 7)


def brute(rows, stride=100, firsts=6):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", hashlib.sha256((text or "").encode()).digest(), text or ""))
    own = {c: [(r, x) for _, _, r, _, x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % firsts
        base = c - (abs(c) % stride) * (1 if c >= 0 else -1)
        rebuilt[c] = own.get(base, [])[:h] + turns[h:]
    members, kids = defaultdict(list), defaultdict(set)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            p = tuple(rebuilt[c][:d])
            members[p].append(c)
            if d:
                kids[p[:-1]].add(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(saved[k] for k in kids[p])
    out = Counter()
    for p, m in members.items():
        ids = ",".join(str(c) for c in m if len(rebuilt[c]) == len(p))
        out[(m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(kids[p]), leaves[p], saved[p],
             hashlib.sha256(ids.encode()).hexdigest())] += 1
    return out


def check(spark, rows, **kw):
    df = spark.createDataFrame([turn(*r) for r in rows], SCHEMA).repartition(3)
    got = C.conversation_trie(df, **kw)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                           "ends_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == brute(rows, **kw)


def test_odd_rows_shared_beginnings_chains_and_copies(spark):
    rows = [(0, i, "user", f"turn {i}") for i in range(5)] + [(0, None, None, None), (0, 3, "user", "turn 3")]
    rows += [(i, t, "user" if t % 2 else None, f"own {t} of {i % 3}") for i in range(1, 12) for t in range(i % 5)]
    rows += [(100, 0, "a", "b"), (100, 0, "ab", ""), (101, 0, "", "ab"), (205, 1, "x", None), (207, 1, "x", ""),
             (None, 0, "lost", "turn"), (None, None, None, None), (-3, 0, "minus", "é\U0001F600"), (-100, 0, "minus", "base"),
             (300, 0, "u", "long " * 20_000), (301, 0, "u", "long " * 20_000), (302, 7, "u", "tie b"), (302, 7, "u", "tie a")]
    rng = random.Random(3)
    for c in range(60):  # chains: each conversation goes on from the one before; copies; branches
        kind = c % 4
        n = c // 2 if kind == 0 else rng.randrange(1, 12)
        rows += [(1000 + c, t, "u", "hot" if t == 0 else f"step {t}" if kind < 2 else f"{rng.randrange(2)}") for t in range(n)]
    rows += [(2000 + c, t, "u", f"copy {t}") for c in range(40) for t in range(3)]
    check(spark, rows)


def test_no_rows_and_no_turns(spark):
    check(spark, [(None, 1, "a", "b")])
    alone = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 >= 2)  # its turns go, its base is absent
    check(spark, [(alone, 0, "u", "a"), (alone, 1, "u", "b")])


def test_a_long_conversation_with_a_third_of_all_rows(spark):
    rows = [(1, t, "u", f"t{t}") for t in range(5000)]
    rows += [(2 + c, t, "u", f"t{t}" if t < c else f"other {c}") for c in range(60) for t in range(60)]
    rows += [(3000 + c, 0, "u", "hot") for c in range(5000)]
    check(spark, rows, stride=1_000_000, firsts=1)


def test_ids_of_one_end_hashed_in_parts(spark):
    df = spark.range(5, 2005, 3).select(F.lit(1).cast("long").alias("x1"), F.lit(2).cast("long").alias("x2"),
                                        F.lit(3).cast("long").alias("total"), F.col("id").alias("conv_id"))
    df = df.unionByName(df.limit(1).withColumn("x1", F.lit(9).cast("long")))
    got = {r.x1: r.ends_sha256 for r in C.ends(df.repartition(7), ids_at_once=100).collect()}
    want = hashlib.sha256(",".join(map(str, range(5, 2005, 3))).encode()).hexdigest()
    assert got[1] == want and got[9] == hashlib.sha256(b"5").hexdigest() and len(got) == 2


@pytest.mark.parametrize("a,b", [(0, 1), (0, 8), (3, 7), (4, 7), (5, 6), (7, 8), (8, 15), (1000, 70_000)])
def test_two_fattest(spark, a, b):
    got = spark.range(1).select(zfast_trie.two_fattest(F.lit(a).cast("long"), F.lit(b).cast("long")).alias("f")).first().f
    assert got == max(range(a + 1, b + 1), key=lambda x: x & -x)


def test_batches_give_the_same_nodes(spark):
    rng = random.Random(8)
    words = {tuple(rng.randrange(2) for _ in range(rng.randrange(1, 9))) for _ in range(80)}
    rows = [(s, d, hash(w[:d]) & 0xFFFF_FFFF, 1 + len(w[:d])) for s, w in enumerate(sorted(words)) for d in range(1, len(w) + 1)]
    prefixes = spark.createDataFrame(rows, "s long, d long, x1 long, x2 long")
    strings = spark.createDataFrame([(s, len(w)) for s, w in enumerate(sorted(words))], "s long, total long")
    found = []
    for batches in ((1.0,), (0.1, 0.3, 1.0)):
        nodes = zfast_trie.build(strings, prefixes, batches).collect()
        found.append(sorted((r.e1, r.e2, r["len"], r.plen, r.f, r.h1, r.c1) for r in nodes))
        assert all(r.f == max(range(r.plen + 1, r["len"] + 1), key=lambda x: x & -x) for r in nodes)
    every = {w[:d] for w in words for d in range(1, len(w) + 1)}
    ends = {p for p in every if p in words or sum(p + (x,) in every for x in (0, 1)) == 2}
    assert found[0] == found[1] and len(found[0]) == len(ends)


def chain(spark, n):
    """Strings each of which goes on from the one before, as ``strings`` and ``prefixes``."""
    strings = spark.createDataFrame([(s, s) for s in range(1, n + 1)], "s long, total long")
    return strings, strings.select("s", F.explode(F.sequence(F.lit(1).cast("long"), "total")).alias("d")).select(
        "s", "d", F.xxhash64("d").alias("x1"), F.xxhash64(F.lit(1), "d").alias("x2"))


def test_a_batch_is_inserted_at_once_however_many_branches_follow_each_other(spark, monkeypatch):
    tables = []
    monkeypatch.setattr(zfast_trie, "written", lambda spark, df: tables.append(0) or C.written(spark, df))
    count = {}
    for n in (3, 12):
        tables.clear()
        nodes = zfast_trie.build(*chain(spark, n), batches=(1.0,)).collect()
        assert sorted((r.plen, r["len"]) for r in nodes) == [(d - 1, d) for d in range(1, n + 1)]
        count[n] = len(tables)
    assert count[3] == count[12]


def test_nodes_of_a_string_put_in_order_in_blocks_of_depths(spark):
    strings, prefixes = chain(spark, 40)
    some = strings.where("s in (1, 2, 9, 16, 17, 40)").unionByName(spark.createDataFrame([(99, 40)], strings.schema))
    prefixes = prefixes.join(some.select("s"), "s", "left_semi")
    twin = prefixes.where("s = 40").select(F.lit(99).cast("long").alias("s"), "d", *[  # parts from s = 40 after 23
        F.when(F.col("d") > 23, -F.col("d")).otherwise(F.col(x)).alias(x) for x in ("x1", "x2")])
    for batches, block in (((1.0,), 4), ((0.5, 1.0), 1)):
        nodes = zfast_trie.build(some, prefixes.unionByName(twin), batches, block).collect()
        assert sorted((r.plen, r["len"]) for r in nodes) == [(0, 1), (1, 2), (2, 9), (9, 16), (16, 17), (17, 23),
                                                             (23, 40), (23, 40)]
