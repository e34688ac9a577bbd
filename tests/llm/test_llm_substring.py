"""Repeated word windows against plain Python, and SQL on the small table."""

import hashlib
import random

import pytest

from tessera.llm.substring_dedup import remove_repeated_words

from llm_helpers import nothing, odd, WORD  # noqa: F401


def brute(rows, length):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = set(), {}
    for i, t in order:
        w = WORD.findall(t or "")
        gone = set()
        for s in range(len(w) - length + 1):
            g = tuple(w[s:s + length])
            if g in seen:
                gone |= set(range(s, s + length))
            seen.add(g)
        out[i] = (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    return out


def texts(seed, n):
    rnd = random.Random(seed)
    words = "a b c d e f".split()
    passages = [[rnd.choice(words) for _ in range(rnd.randint(5, 40))] for _ in range(4)]
    out = []
    for i in range(n):
        t = []
        for _ in range(rnd.randint(0, 4)):
            t += rnd.choice(passages) if rnd.random() < 0.6 else [rnd.choice(words) for _ in range(rnd.randint(1, 15))]
        out.append((i * 3 % n, rnd.choice([" ", "\n", " \t "]).join(t)))
    return out


@pytest.mark.parametrize("seed,length,seed_words", [(1, 6, 2), (2, 8, 3), (3, 20, 6)])
def test_random_texts(spark, seed, length, seed_words):
    rows = texts(seed, 40)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in remove_repeated_words(docs, length, seed_words).collect()}
    assert got == brute(rows, length)


def test_odd_rows_and_no_rows(spark, odd, nothing):
    got = remove_repeated_words(odd).collect()
    assert len(got) == odd.count()
    want = brute([(r.doc_id, r.text) for r in odd.collect() if r.doc_id not in (None, 12)], 20)
    for r in got:
        if r.doc_id in want:
            assert (r.n_words, r.n_removed, r.kept) == want[r.doc_id], r.doc_id
    assert remove_repeated_words(nothing).collect() == []


def test_a_passage_in_a_third_of_all_documents(spark):
    hot = " ".join(f"p{k}" for k in range(45))
    rows = [(i, f"x{i} y{i} " + (hot if i % 3 == 0 else f"only{i}") + f" z{i}") for i in range(300)]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept)
           for r in remove_repeated_words(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows, 20)
    assert hashlib.sha256(got[3][2].encode()).hexdigest() == hashlib.sha256(b"x3 y3 z3").hexdigest()
