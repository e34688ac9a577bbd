"""Importance resampling: CRC arithmetic, automaton scans, weights and draws against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import crc, importance

from llm_helpers import lower_ascii, nothing, odd  # noqa: F401

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=40), st.binary(min_size=1, max_size=40)), min_size=1, max_size=8))
def test_crc_of_joined_strings(pairs):
    first = np.array([zlib.crc32(a) for a, _ in pairs], np.uint32)
    second = np.array([zlib.crc32(b) for _, b in pairs], np.uint32)
    lengths = np.array([len(b) for _, b in pairs])
    assert crc.combine(first, second, lengths).tolist() == [zlib.crc32(a + b) for a, b in pairs]
    assert crc.append_byte(first, 0x20).tolist() == [zlib.crc32(a + b" ") for a, _ in pairs]


def test_crc_of_very_long_parts_and_many_lengths():
    a, b = b"head", b"x" * 5_000_001
    assert crc.combine(*(np.array([zlib.crc32(v)], np.uint32) for v in (a, b)), np.array([len(b)]))[0] == zlib.crc32(a + b)
    parts = [bytes([65 + n % 26]) * n for n in range(1, 2500)]
    got = crc.combine(np.full(len(parts), zlib.crc32(a), np.uint32),
                      np.array([zlib.crc32(p) for p in parts], np.uint32), np.array([len(p) for p in parts]))
    assert got.tolist() == [zlib.crc32(a + p) for p in parts]


def words(text):
    return WORD.findall(lower_ascii(text or ""))


def features(text, run=2):
    w = words(text)
    return [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in range(1, run + 1) for i in range(len(w) - k + 1)]


def brute(rows, target, percent=25, least=20, run=2):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text, run))
    for text in target:
        t.update(features(text, run))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)]
    out = []
    for i, text in rows:
        f = features(text, run)
        w = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text)) >= least))
    can = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0]))
    drawn = {}
    for k, r in enumerate(can[: percent * len(can) // 100], 1):
        drawn.setdefault(r[:4], []).append(k)
    return Counter((*r[:4], drawn[r[:4]].pop(0) if drawn.get(r[:4]) else None) for r in out)


def check(docs, target, **kw):
    got = importance.importance_sample(docs, target, **kw)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()],
                 **{"least" if k == "least_words" else k: v for k, v in kw.items()})
    assert Counter(tuple(r) for r in got.collect()) == want


def test_whole_tables(spark):
    for sf in ("sf0.001", "sf0.01"):
        d = f"/root/testdata/{sf}"
        check(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet"))


def test_odd_rows_and_no_rows(spark, odd, nothing):
    target = spark.createDataFrame([("the quick brown fox",), (None,), ("",)], "text string")
    check(odd.repartition(3), target)
    check(odd, target, percent=100, least_words=0)
    check(odd, nothing.select("text"))
    check(odd, target, run=3)
    check(odd, target, run=1)
    check(nothing, target)


def test_slices_and_long_words(spark):
    text = "Alpha beta-gamma " * 40 + "q" * 700 + " é" + "ü" * 300 + " " + "q" * 700 + " \x00\x01 tail 12"
    docs = spark.createDataFrame([(1, text), (2, "x"), (3, None), (4, "q" * 5000), (5, text * 3)], "doc_id long, text string")
    want = {r.doc_id: sorted(features(r.text)) for r in docs.collect()}
    for chunk in (50, 1000, 1 << 20):
        got = importance.feature_buckets(docs, chunk=chunk).collect()
        assert {r.doc_id: sorted(np.frombuffer(r.buckets, np.uint16).tolist()) for r in got} == want
        assert {r.doc_id: r.n_words for r in got} == {r.doc_id: len(words(r.text)) for r in docs.collect()}


def test_a_text_of_50_mb(spark):
    docs = spark.createDataFrame([(1,), (2,)], "doc_id long").selectExpr(
        "doc_id", "if(doc_id = 1, repeat('wörd Number 7 and more, ', 2200000), 'short one') as text")
    got = {r.doc_id: r for r in importance.feature_buckets(docs).collect()}
    assert got[1].n_words == 11_000_000 and got[1].n_features == 21_999_999 and got[2].n_features == 3
    counts = Counter(np.frombuffer(got[1].buckets, np.uint16).tolist())
    assert counts == Counter({b: n for b, n in Counter(
        {zlib.crc32(w.encode()) % 10000: 2_200_000 for w in ("wörd", "number", "7", "and", "more", "wörd number", "number 7",
                                                             "7 and", "and more")}).items()}) + Counter(
        {zlib.crc32("more wörd".encode()) % 10000: 2_199_999})


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB1 é-\x00\x7f", max_size=30), min_size=1, max_size=5), st.integers(1, 4))
def test_scan_and_compose(texts, run):
    rows = [t.encode().translate(importance._DELIMITED) for t in texts]
    found = importance.scan(b" \x00 ".join(rows))
    values, ends = importance.compose(found, np.empty(0, np.uint64), run=run)
    assert sorted(values.tolist()) == sorted(b for t in texts for b in features(t, run))
    assert ends.sum() == len(values)
