"""Suffix arrays and repeated byte strings against plain Python."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import suffix_dedup
from tessera.llm.suffix_array import common_prefixes, suffix_array
from tessera.llm.suffix_dedup import remove_repeats
from tessera.llm.windows import sliding_min

from llm_helpers import nothing, odd  # noqa: F401


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=80), st.integers(1, 4))
def test_suffix_array_and_prefixes(values, times):
    text = np.array(values * times, dtype=np.uint8)
    raw = text.tobytes()
    want = sorted(range(len(raw)), key=lambda i: raw[i:])
    sa = suffix_array(text)
    assert sa.tolist() == want
    got = common_prefixes(text, sa, 20)
    for n, (a, b) in zip(got[1:], zip(want, want[1:])):
        true = next((k for k, (x, y) in enumerate(zip(raw[a:], raw[b:])) if x != y), len(raw) - max(a, b))
        assert n == true if true < 20 else n >= 20


def test_sliding_min():
    v = np.random.default_rng(0).integers(0, 100, 57).astype(np.uint64)
    for width in (1, 3, 10, 57, 60):
        assert sliding_min(v, width).tolist() == [v[i:i + width].min() for i in range(len(v) - width + 1)]


def brute(rows, length):
    count = Counter()
    raws = [(i, (t or "").encode()) for i, t in rows]
    for _, b in raws:
        count.update(b[s:s + length] for s in range(len(b) - length + 1))
    out = Counter()
    for i, b in raws:
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if count[b[s:s + length]] > 1:
                gone[s:s + length] = True
        runs = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(b) else 0
        out[i, len(b), int(gone.sum()), runs, np.frombuffer(b, np.uint8)[~gone].tobytes()] += 1
    return out


def found(df):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect())


def texts(seed, n):
    rnd = random.Random(seed)
    passages = ["".join(rnd.choice("abé ") for _ in range(rnd.randint(20, 90))) for _ in range(4)]
    out = []
    for i in range(n):
        t = ""
        for _ in range(rnd.randint(0, 4)):
            t += rnd.choice(passages) if rnd.random() < 0.6 else "".join(rnd.choice("abc ") for _ in range(rnd.randint(1, 30)))
        out.append((i, t))
    return out


@pytest.mark.parametrize("seed,length,split_at", [(1, 24, 512), (2, 40, 2), (3, 16, 3)])
def test_random_texts(spark, monkeypatch, seed, length, split_at):
    plain = suffix_dedup.repeated_runs
    monkeypatch.setattr(suffix_dedup, "repeated_runs",
                        lambda *a, **k: plain(*a, **k | {"split_at": split_at, "shard_bytes": 2000}))
    rows = texts(seed, 50)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(remove_repeats(docs, length, 8)) == brute(rows, length)


def test_odd_rows_and_no_rows(spark, odd, nothing):
    assert found(remove_repeats(odd, 100, 16)) == brute([(r.doc_id, r.text) for r in odd.collect()], 100)
    assert remove_repeats(nothing).collect() == []


def test_long_rows_come_in_slices(spark, monkeypatch):
    from tessera.llm import window_runs
    monkeypatch.setattr(window_runs, "CHUNK", 300)
    rows = [(1, "".join(random.Random(5).choice("abcdefgh") for _ in range(2000))), (2, "q" * 900)]
    rows.append((3, "head " + rows[0][1][500:1500] + " tail"))
    data = [np.frombuffer(t.encode(), np.uint8) for _, t in rows]
    offsets = np.concatenate(([0], np.cumsum([len(d) for d in data])))
    seen = set()
    for a, skip, own, bounds in window_runs.byte_symbols(np.concatenate(data), offsets, 50):
        from tessera.llm import windows
        row, start, n, _, _ = windows.runs(own, bounds, 50, 10)
        for r, s, k in zip(row, start, n):
            for w in range(s + skip, s + skip + k):
                assert (r + a, w) not in seen
                seen.add((r + a, w))
    assert seen == {(r, w) for r, d in enumerate(data) for w in range(len(d) - 49)}
