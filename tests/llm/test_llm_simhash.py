"""SimHash fingerprints, grid links and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from tessera.llm.components import components
from tessera.llm.simhash import (
    _cell_links, drop_near_duplicates, fingerprint, fingerprint_links, grid_masks, near_groups,
)

from llm_helpers import lower_ascii, nothing, odd, WORD  # noqa: F401


def brute_fingerprint(text, k=3):
    words = WORD.findall(lower_ascii(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs, max_bits=3):
    """Smallest id reachable for each (id, fingerprint)."""
    parent = list(range(len(pairs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(pairs)):
        for j in range(i):
            if bin(pairs[i][1] ^ pairs[j][1]).count("1") <= max_bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    groups = {}
    for i, (d, _) in enumerate(pairs):
        groups.setdefault(find(i), []).append(d)
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return [least[find(i)] for i in range(len(pairs))]


@pytest.mark.parametrize("text", ["", " \n", "One", "one TWO", "a b c", "É é É é a\x0bb", "w " * 70_000])
def test_fingerprint(text):
    assert fingerprint(text.encode()) == brute_fingerprint(text)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pairs = sorted((r.doc_id, brute_fingerprint(r.text)) for r in docs.collect())
    want = brute_components(pairs)
    got = sorted((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in near_groups(docs).collect())
    assert got == [(d, f, c) for (d, f), c in zip(pairs, want)]
    assert all(re.fullmatch("[0-9a-f]{16}", r.fingerprint) for r in near_groups(docs).collect())
    left = drop_near_duplicates(docs)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == sorted(set(want))


def test_odd_rows_and_no_rows(spark, odd, nothing):
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in odd.collect()]
    want = brute_components(rows)
    got = [(r.doc_id, int(r.fingerprint, 16), r.component_id) for r in near_groups(odd).collect()]
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(got, key=key) == sorted([(d, f, c) for (d, f), c in zip(rows, want)], key=key)
    kept = drop_near_duplicates(odd).collect()
    assert len(kept) == len(set(brute_components([(i, f) for i, (_, f) in enumerate(rows)])))
    assert near_groups(nothing).collect() == [] and drop_near_duplicates(nothing).collect() == []


@pytest.mark.parametrize("chunk", [4096, 5])
def test_links_connect_all_close_fingerprints(spark, chunk):
    rnd = random.Random(4)
    base = [rnd.getrandbits(64) for _ in range(20)]
    fps = set(base)
    for b in base[:6]:
        for _ in range(30):
            for _ in range(rnd.randint(1, 4)):
                b ^= 1 << rnd.randrange(64)
            fps.add(b)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in sorted(fps)]
    df = spark.createDataFrame(signed, "fp long").repartition(4)
    links = fingerprint_links(df, 3, chunk=chunk)
    rooted = {r.v: r.root for r in components(spark, links.toDF("a", "b")).collect()}
    order = [s for s, in signed]
    want = brute_components([(s, s & (2 ** 64 - 1)) for s in order])
    assert [rooted.get(s, s) for s in order] == want


def test_every_close_pair_shares_a_grid_cell():
    masks = grid_masks(3)
    for _ in range(300):
        bits = random.sample(range(64), 3)
        touched = sum({3 << (b // 2 * 2) for b in bits})
        assert any(not m & touched for m in masks)


def test_a_large_cell_gives_no_more_links_than_fingerprints():
    fps = np.array([1 << i for i in range(64)] + [(1 << i) | (1 << (i + 1)) for i in range(63)], dtype=np.uint64)
    assert len(_cell_links(fps, 3)) == len(fps) - 1


def test_components_of_a_path_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(200, 260)] + [(5, 5), (-3, 9), (9, -3)]
    got = {r.v: r.root for r in components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == ({i: 100 for i in range(100, 161)} | {7: 7} | {k: 7 for k in range(200, 260)} | {-3: -3, 9: -3})
    assert components(spark, spark.createDataFrame([], "a long, b long")).collect() == []
