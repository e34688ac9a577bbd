"""Weighted fair queueing against plain Python; targets; odd rows."""

import hashlib
from collections import Counter

import pytest

from conftest import SF_SMALL
from tessera.llm.mixing import mix_documents, mix_report, op2_mixing

from llm_helpers import nothing, odd, WORD  # noqa: F401


def brute(rows, weights=(5, 2, 1), epochs=3):
    """Times taken of each (doc_id, source, size) unit, and the targets by source."""
    units = Counter((i, s, len(WORD.findall(t or ""))) for i, t, s in rows)
    names = sorted({s for _, s, _ in units}, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    size = Counter()
    for (_, s, n), c in units.items():
        size[s] += n * c
    target, left, open_ = {}, sum(size.values()), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if epochs * size[s] < weight[s] * level]
        if not full:
            target |= {s: weight[s] * level for s in open_}
            break
        for s in full:
            target[s] = epochs * size[s]
            left -= target[s]
            open_.remove(s)
    entries = []
    for s in names:
        own = sorted((hashlib.md5(f"mix|{'null' if i is None else i}|{n}".encode()).hexdigest(), i is not None, i or 0, n)
                     for i, s2, n in units if s2 == s)
        cum = 0
        for key, has, i, n in own:
            c = units[(i if has else None, s, n)]
            cum += n * c
            entries += [((e * size[s] + cum) / weight[s], key, s is None, s or "", e, (i if has else None, s, n), n * c)
                        for e in range(epochs)]
    times, total = Counter(), 0
    for *_, unit, words in sorted(entries, key=lambda x: x[:5]):
        total += words
        if total > sum(size.values()):
            break
        times[unit] += 1
    return times, target, size, units


@pytest.mark.parametrize("which", ["small", "odd"])
def test_report_against_plain_python(spark, odd, which):
    docs = odd if which == "odd" else spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    times, target, size, units = brute(rows)
    got = mix_report(docs).collect()
    assert len(got) == len(rows)
    source = {(i, len(WORD.findall(t or ""))): s for i, t, s in rows}
    for r in got:
        s = source[r.doc_id, r["size"]]
        assert r.source_size == size[s] and r.target == pytest.approx(target[s])
        assert r.taken == r["size"] * times[r.doc_id, s, r["size"]] <= 3 * r["size"]


def test_targets_are_met_and_reruns_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mix_report(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    taken, target, largest = Counter(), {}, Counter()
    for r in rows:
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r["size"])
    # whole documents: a source is off by less than its largest one
    assert all(abs(taken[s] - t) < largest[s] for s, t in target.items())
    again = op2_mixing(spark, "/root/testdata/sf0.01").collect()
    assert sorted(map(tuple, again)) == sorted((r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in rows)


def test_documents_are_repeated_with_all_their_columns(spark, odd):
    out = mix_documents(odd)
    assert out.columns == odd.columns
    times, _, _, units = brute([(r.doc_id, r.text, r.source) for r in odd.collect()])
    got = Counter((r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in out.collect())
    assert got == Counter({u: times[u] * c for u, c in units.items() if times[u]})


def test_nothing_and_no_words(spark, nothing):
    assert mix_report(nothing).collect() == [] and mix_documents(nothing).collect() == []
    blank = spark.createDataFrame([(1, " ", "s"), (2, None, None)], "doc_id long, text string, source string")
    assert sorted((r.doc_id, r.taken, r.target) for r in mix_report(blank).collect()) == [(1, 0, 0.0), (2, 0, 0.0)]
