"""The language model against counts in plain Python."""

import math
import os
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import ngram_lm
from tessera.llm.ngram_lm import discounts, held_out, op5_ngram_lm, score_documents, train

from llm_helpers import doc, DOC_SCHEMA, lower_ascii, nothing, odd, WORD  # noqa: F401


def tokens(text):
    return [*WORD.findall(lower_ascii(text or "")), None]


def of_counts(counts):
    c = Counter(counts)
    return discounts([c[i] for i in (1, 2, 3, 4)])


class Brute:
    """Interpolated modified Kneser-Ney as it is defined; 0 stands before texts."""

    def __init__(self, texts, order=ngram_lm.ORDER):
        self.order, seqs = order, [tokens(t) for t in texts]
        self.uni = Counter(w for s in seqs for w in s)
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        top = Counter()
        for s in seqs:
            row = [0] * (order - 1) + s
            top.update(tuple(row[i:i + order]) for i in range(len(s)))
        # below the highest order an n-gram counts the different tokens before it
        self.counts = {order: top}
        for k in range(order - 1, 0, -1):
            wider = set()
            for s in seqs:
                row = [0] * k + s
                wider.update(tuple(row[i:i + k + 1]) for i in range(len(s)))
            self.counts[k] = Counter(g[1:] for g in wider)
        self.off = {k: of_counts(c.values()) for k, c in self.counts.items()}
        self.all, self.kinds = Counter(), {}
        for k, counted in self.counts.items():
            for g, c in counted.items():
                self.all[k, g[:-1]] += c
                self.kinds.setdefault((k, g[:-1]), [0, 0, 0])[min(c, 3) - 1] += 1

    def p(self, context, w, k=None):
        k = self.order if k is None else k
        if k == 0:
            return 1 / (self.v + 1)
        context = tuple(context)[len(context) - k + 1:]
        lower = self.p(context[1:], w, k - 1)
        if not self.all[k, context]:
            return lower
        c = self.counts[k].get((*context, w), 0)
        left = sum(a * b for a, b in zip(self.off[k], self.kinds[k, context])) / self.all[k, context]
        return (c - self.off[k][min(c, 3) - 1] if c else 0) / self.all[k, context] + left * lower

    def score(self, s):
        row = [0] * (self.order - 1) + s
        return sum(math.log10(self.p(row[i:i + self.order - 1], w)) for i, w in enumerate(s))


def check(rows, docs, brute):
    assert len(rows) == len(docs)
    texts = {}
    for i, t in docs:
        texts.setdefault(i, []).append(t)
    for r in rows:
        fits = False
        for t in texts[r.doc_id]:
            s = tokens(t)
            if (r.n_tokens, r.n_known, r.train_tokens) != (len(s), sum(brute.uni[w] > 0 for w in s), brute.n):
                continue
            base = sum(math.log10((brute.uni[w] + 1) / (brute.n + brute.v + 1)) for w in s)
            fits = fits or (r.score == pytest.approx(brute.score(s), abs=1e-6)
                            and r.base_score == pytest.approx(base, abs=1e-6))
        assert fits, r


def training(docs):
    return [t for i, t in docs if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]


def test_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    brute = Brute(training(docs))
    assert brute.order == 3
    rows = op5_ngram_lm(spark, sf).collect()
    check(rows, docs, brute)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # better than single tokens
    some = tokens(docs[0][1])[3:5]
    for context in ([0, 0], some, ["nowhere", some[0]]):
        assert sum(brute.p(context, w) for w in brute.uni) + brute.p(context, "nothing") == pytest.approx(1.0)


@pytest.mark.parametrize("order, key_bits", [(2, 64), (3, 64), (3, 9), (4, 64)])
def test_odd_rows_and_small_shards(spark, odd, order, key_bits):
    """Also with keys so short that tokens choose their owners, and texts in slices."""
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    model = train(odd.where(~held_out()), order=order, per_shard=500, key_bits=key_bits, chunk=600)
    assert model.grams[0].bits >= 4 and (model.grams[-1].classes > 0) == (key_bits < 64)
    check(score_documents(odd, model, chunk=70).collect(), docs, Brute(training(docs), order))


def test_no_training_text(spark, odd, nothing):
    empty = train(nothing)
    rows = score_documents(odd, empty).collect()
    assert all(r.score == r.base_score == 0.0 and r.n_known == 0 for r in rows)
    assert score_documents(nothing, empty).collect() == []
    with pytest.raises(ValueError):
        train(odd, order=1)


@pytest.mark.parametrize("grams", [ngram_lm.Grams(4, 45, 21), ngram_lm.Grams(3, 50, 20, 3), ngram_lm.Grams(2, 64, 30),
                                   ngram_lm.Grams(5, 20, 9), ngram_lm.Grams(6, 6, 3)])
def test_kept_keys(grams):
    """Keys of every width, with and without an index, give their parts back; others are not found."""
    rng, owned = np.random.default_rng(1), {}
    bits = min(grams.width - grams.token_bits, 24)
    context = rng.integers(0, 1 << bits, 4000)
    token = rng.integers(0, 1 << min(grams.token_bits + grams.classes, 20), 4000)
    kinds, keys = grams.keys(context, token)
    for kind in np.unique(kinds):
        sorted_keys = np.unique(keys[kinds == kind])
        cuts = grams.ranges(sorted_keys)
        for s in np.flatnonzero(np.diff(cuts)):
            owned[int(kind << grams.bits | s)] = sorted_keys[cuts[s]:cuts[s + 1]]
    back = set()
    for owner, mine in owned.items():
        high, held = grams.local(mine)
        index = grams.index(high)
        at, hit = ngram_lm._place(held, held, high, index)
        assert hit.all() and list(at) == list(range(len(mine)))
        back |= set(zip(*(x.tolist() for x in grams.parts(owner, high, held))))
        # the same low bits under other leading bits
        other = np.roll(np.arange(len(index) - 1), 1)[high]
        _, hit = ngram_lm._place(held, held, other, index)
        truth = set(zip(high.tolist(), held.tolist()))
        assert hit.tolist() == [p in truth for p in zip(other.tolist(), held.tolist())]
    assert back == set(zip(context.tolist(), token.tolist()))


def test_maps_are_bounded(spark, odd, monkeypatch):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    model = train(odd, per_shard=50)
    monkeypatch.setattr(ngram_lm, "MAPS", 5)
    brute = Brute([t for _, t in docs])
    data = "the quick brown fox".encode()
    got = model.score(next(ngram_lm.pieces(np.frombuffer(data, np.uint8), np.array([0, len(data)]), model.lead))[2])
    assert got["score"][0] == pytest.approx(brute.score(tokens(data.decode())), abs=1e-9)
    assert 0 < len(model._maps) <= 5


def test_files_do_not_grow_with_owners(spark, odd):
    """As many files, and as many opened by a chunk, for 16 owners of keys as for 256; all scores alike."""
    few, many = train(odd, per_shard=1_000_000), train(odd, per_shard=50)
    assert len(few.grams[0].bases) == 17 and len(many.grams[0].bases) == 257
    files = [sorted(os.listdir(m.folder)) for m in (few, many)]
    assert files[0] == files[1] and len(files[0]) < 30
    data = "the quick brown fox".encode()
    for m in (few, many):
        m.score(next(ngram_lm.pieces(np.frombuffer(data, np.uint8), np.array([0, len(data)]), m.lead))[2])
        assert len(m._maps) < 25
    scores = [sorted((str(r.doc_id), r.n_tokens, round(r.score, 9)) for r in score_documents(odd, m).collect())
              for m in (few, many)]
    assert scores[0] == scores[1]


@pytest.mark.parametrize("width", [3, 20, 47, 64])
def test_distinct_keys(width):
    rng = np.random.default_rng(width)
    for n in (0, 1, 2, 5000):
        keys = rng.integers(0, 1 << min(width, 63), n).astype(np.uint64) << np.uint64(width == 64)
        keys = np.concatenate([keys, keys[: n // 3]])
        distinct, back = ngram_lm._distinct(keys, width)
        assert (distinct[back] == keys).all() and set(distinct.tolist()) == set(keys.tolist())
        assert len(distinct) <= len(keys)
        if width + 13 <= 64:
            assert (distinct == np.unique(keys)).all()


def test_very_long_text_in_slices(spark):
    """Twelve million bytes in one row: counted and scored in slices, as counts say."""
    words = np.array(["alpha", "beta", "gamma", "delta", "eps", "zeta"])
    row = words[np.random.default_rng(3).integers(0, len(words), 2_000_000)]
    text = "  ".join(row)
    df = spark.createDataFrame([doc(1, text), doc(2, "alpha beta"), doc(3, None)], DOC_SCHEMA)
    got = {r.doc_id: r for r in score_documents(df, train(df)).collect()}
    assert len(text) > 4 * ngram_lm.CHUNK and got[1].n_tokens == got[1].n_known == len(row) + 1
    assert got[1].train_tokens == len(row) + 1 + 3 + 1
    brute = Brute([text, "alpha beta", None])
    assert got[2].score == pytest.approx(brute.score(tokens("alpha beta")), abs=1e-9)
    seq = [0, 0, *row, None]
    whole = sum(n * math.log10(brute.p(g[:2], g[2])) for g, n in Counter(zip(seq, seq[1:], seq[2:])).items())
    assert got[1].score == pytest.approx(whole, rel=1e-9)
