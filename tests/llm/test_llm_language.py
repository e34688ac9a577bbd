"""Language identification: accuracy on held-out documents, and odd rows."""

import random
import zlib

import numpy as np
import pytest

from tessera.llm import language
from tessera.llm.language import UNKNOWN, LanguageModel, drop_unidentified, fit, fit_svm, identify, op4_language

from llm_helpers import nothing, odd  # noqa: F401

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op4_language(spark, SF).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.lang_pred in {"en", "de", "fr", "es"} for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) > 0.99 * len(held)


def test_odd_rows(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(400)
    model = fit(docs)
    got = identify(odd, model).collect()
    assert len(got) == odd.count()
    pred = {r.doc_id: r.lang_pred for r in got if r.doc_id is not None}
    assert all(pred[i] == UNKNOWN for i in (4, 5, 6, 8)) and pred[1] != UNKNOWN
    assert all(r.score == 0.0 for r in got if r.lang_pred == UNKNOWN)
    kept = drop_unidentified(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 7, 9, 10, 11, 12, 12, 12, 13]


def test_no_rows_no_labels_one_language(spark, nothing):
    empty = fit(nothing)
    assert empty.languages == [] and identify(nothing, empty).collect() == []
    one = spark.createDataFrame([(1, "hello there", "en"), (2, "more words", "en"), (3, "??", None)],
                                "doc_id long, text string, lang string")
    assert [r.lang_pred for r in identify(one, empty).collect()] == [UNKNOWN] * 3
    model = fit(one)
    assert [(r.lang_pred, r.score) for r in identify(one, model).collect()] == [("en", 1.0)] * 2 + [(UNKNOWN, 0.0)]


def test_languages_outside_the_table_are_families_of_their_own(spark):
    rows = [(i, w * (5 + i), g) for i in range(12) for w, g in (("aba bab ", "qaa"), ("zuz uzu ", "qab"), ("kik iki ", "en"))]
    model = fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.groups == [["en"], ["qaa"], ["qab"]] and len(model.keys) == 3
    got = identify(spark.createDataFrame([(1, "bab aba"), (2, "uzu zuz uz")], "doc_id long, text string"), model)
    assert [r.lang_pred for r in got.collect()] == ["qaa", "qab"]


def test_more_than_200_labels(spark):
    rng = random.Random(5)
    words = {f"l{k:03}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(6)] for k in range(220)}
    # the last labels are the rarest
    docs = [(1000 * k + i, " ".join(rng.choices(ws, k=30)), lang)
            for k, (lang, ws) in enumerate(words.items()) for i in range(4 if k < 200 else 3)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(4)
    model = fit(df)
    assert set(model.languages) == set(words) and len(model.keys) < 2000
    got = {r.doc_id: r.lang_pred for r in identify(df.where("doc_id >= 196000"), model).collect()}
    truth = {i: lang for i, _, lang in docs if i >= 196000}
    assert set(got) == set(truth)
    assert sum(got[i] == truth[i] for i in truth) > 0.95 * len(truth)


@pytest.mark.parametrize("c, apart", [(10.0, 0.5), (1.0, 0.2), (0.1, 3.0)])
def test_svm_is_the_minimum_of_its_loss(c, apart):
    """Against Newton steps on the primal loss: half the squared weights and bias, c times squared hinges."""
    rng = np.random.default_rng(4)
    y = np.where(np.arange(80) % 3 == 0, 1.0, -1.0)
    x = (rng.normal(size=(80, 6)) + apart * y[:, None]).astype(np.float32)
    w, bias = fit_svm(x, y, c=c, rounds=2000)
    z = np.hstack([x, np.ones((80, 1))]).astype(np.float64)
    plain = np.zeros(7)
    for _ in range(100):
        short = np.maximum(1 - y * (z @ plain), 0)
        near = z[short > 0]
        plain -= np.linalg.solve(np.eye(7) + 2 * c * near.T @ near, plain - 2 * c * z.T @ (y * short))

    def loss(v):
        return 0.5 * v @ v + c * (np.maximum(1 - y * (z @ v), 0) ** 2).sum()

    mine = np.append(w, bias)
    assert loss(mine) <= loss(plain) * 1.001 and np.allclose(mine, plain, atol=2e-2)


def test_margins_sum_the_weights_of_all_ngrams():
    """Against byte n-grams counted one by one, with texts shorter than an n-gram and empty ones."""
    rng, size = np.random.default_rng(8), 1 << language.FEATURE_BITS
    weights = [rng.normal(size=len(language.ORDERS) * size).astype(np.float32) for _ in range(2)]
    model = LanguageModel(["a", "b", "c"], [["a", "b"], ["c"]], {(0, 1): (weights[0], 0.25)}, {("a", "b"): (weights[1], -0.5)})
    texts = [t.encode() for t in ("", "x", "ab", "Abc", "The Quick brown", "", "à la carte, 12!", "lorem " * 500)]

    def folded(raw):
        return [b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in raw]

    def feature(gram):
        code = 0
        for b in gram:
            code = (code * 0x01000193 + b + 1) % 2 ** 32
        return ((code ^ code >> 15) * 0x2C1B3C6D % 2 ** 32) >> (32 - language.FEATURE_BITS)

    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    got = model.margins(np.frombuffer(b"".join(texts), np.uint8), offsets)
    for p, (w, bias) in enumerate(zip(weights, (0.25, -0.5))):
        for i, raw in enumerate(texts):
            row = folded(raw)
            total = sum(float(w[k * size + feature(row[j:j + o])]) for k, o in enumerate(language.ORDERS)
                        for j in range(len(row) - o + 1))
            assert got[p, i] == pytest.approx(total / max(len(row), 1) + bias, abs=1e-4)
