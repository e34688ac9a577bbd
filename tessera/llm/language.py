"""Language identification: the family first, then one-versus-one linear SVMs within it."""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import id_crc, load, row_ranges, text_buffer, text_or_empty

# ISO 639-1 codes by language family (common knowledge).
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "yi", "lb"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl", "oc"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk", "bs"],
    "turkic": ["tr", "az", "kk", "uz", "ky", "tt"],
    "uralic": ["fi", "et", "hu"],
    "baltic": ["lt", "lv"],
    "indo-aryan": ["hi", "bn", "ur", "mr", "gu", "pa", "ne"],
    "semitic": ["ar", "he", "am", "mt"],
}
UNKNOWN = "und"
SURE = 0.7  # score from which a prediction replaces another label (clear texts have about 0.9)
SAMPLE_PER_LANGUAGE = 300  # labelled documents that the classifiers are fitted on, about, of each language
SAMPLE = 60_000  # of all languages together; with more labels each has fewer
LEAST_PER_LANGUAGE = 20  # documents of a language, however many labels there are
OWN_FAMILIES = 64  # labels of no listed family that are families of their own; more are grouped
FEATURE_BITS = 13
ORDERS = (3, 4)  # bytes in a feature
CHUNK = 1 << 21  # bytes of text that are looked at together
HELD_OUT = 5

# Capital letters become small, other ASCII that is no letter becomes a space.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 0x20
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)


def features(part: np.ndarray, order: int) -> np.ndarray:
    """Hashed feature number of the ``order`` bytes from each position (fewer at the end)."""
    folded = _FOLD[part].astype(np.uint32)
    code = np.zeros(len(folded), dtype=np.uint32)
    for j in range(min(order, len(folded))):
        code[: len(folded) - j] = code[: len(folded) - j] * np.uint32(0x01000193) + folded[j:] + np.uint32(1)
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x2C1B3C6D)
    return (code >> np.uint32(32 - FEATURE_BITS)).astype(np.int32)


def _profile(raw: bytes) -> np.ndarray:
    """Feature shares of one text, one row per order laid end to end."""
    part = np.frombuffer(raw, dtype=np.uint8)
    size = 1 << FEATURE_BITS
    out = [np.bincount(features(part, o)[:max(len(part) - o + 1, 0)], minlength=size) for o in ORDERS]
    return (np.concatenate(out) / max(len(part), 1)).astype(np.float32)


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear SVM (squared hinge loss), by dual coordinate descent.

    ``y`` is +1 or -1. The order of steps is fixed, so reruns agree.
    """
    gram = (x @ x.T).astype(np.float64) + 1.0  # the bias is a feature that is always 1
    alpha, margin = np.zeros(len(y)), np.zeros(len(y))
    diag = np.diag(gram) + 0.5 / c
    order = np.random.default_rng(0)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(y)):
            step = (1.0 - y[i] * margin[i] - alpha[i] * 0.5 / c) / diag[i]
            new = max(alpha[i] + step, 0.0)
            if new != alpha[i]:
                margin += (new - alpha[i]) * y[i] * gram[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-4 * max(alpha.max(), 1e-9):
            break
    coef = alpha * y
    return coef.astype(np.float32) @ x, float(coef.sum())


class LanguageModel:
    """Pairs of classes, each with a linear SVM: families first, then languages of one family."""

    def __init__(self, languages: list[str], groups: list[list[str]],
                 between: dict[tuple[int, int], tuple[np.ndarray, float]],
                 within: dict[tuple[str, str], tuple[np.ndarray, float]]):
        self.languages, self.groups, self.between, self.within = languages, groups, between, within
        pairs = [*between.items(), *within.items()]
        self.keys = [k for k, _ in pairs]
        self.weights = (np.stack([w for _, (w, _) in pairs]) if pairs
                        else np.empty((0, len(ORDERS) << FEATURE_BITS), np.float32))
        self.biases = np.array([b for _, (_, b) in pairs])

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Margin of every SVM for every row of a text buffer: a sum of weights over all positions."""
        rows = len(offsets) - 1
        out = np.zeros((len(self.keys), rows))
        size = 1 << FEATURE_BITS
        for a, b in row_ranges(offsets, CHUNK):
            own = offsets[a:b + 1]
            sizes = np.diff(own)
            full = np.flatnonzero(sizes)
            if not len(full):
                continue
            part = data[own[0]:own[-1]]
            firsts = (own[:-1] - own[0])[full]
            for k, order in enumerate(ORDERS):
                code = features(part, order)
                for end in (own[1:] - own[0])[full]:  # features stop where their row stops
                    code[max(end - order + 1, 0):end] = -1
                known = code >= 0
                for p in range(len(self.keys)):
                    w = self.weights[p, k * size:(k + 1) * size]
                    out[p, a + full] += np.add.reduceat(np.where(known, w[code], 0.0), firsts)
            out[:, a + full] /= sizes[full]
        return out + self.biases[:, None]

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score (share of the family times share of the language in it) of each row."""
        rows = len(offsets) - 1
        margins = dict(zip(self.keys, self.margins(data, offsets)))

        def shares(n: int, key) -> np.ndarray:
            total = np.zeros((n, rows))
            for i, j in itertools.combinations(range(n), 2):
                m = np.tanh(margins[key(i, j)])  # a vote with its strength
                total[i] += m
                total[j] -= m
            e = np.exp(2.0 * (total - total.max(axis=0)) / max(n - 1, 1))
            return e / e.sum(axis=0)

        family = shares(len(self.groups), lambda i, j: (i, j))
        best = family.argmax(axis=0)
        names, scores = np.empty(rows, dtype=object), np.zeros(rows)
        for f, members in enumerate(self.groups):
            own = shares(len(members), lambda i, j, m=members: (m[i], m[j]))
            mine = best == f
            names[mine] = np.array(members, dtype=object)[own.argmax(axis=0)[mine]]
            scores[mine] = (family[f] * own.max(axis=0))[mine]
        return names, scores


def unlisted_families(names: list[str]) -> dict[str, str]:
    """Families of sorted labels that no family lists: each its own, or, if very many, the cube root of them together.

    That size keeps the pairs between and within families few.
    """
    size = 1 if len(names) <= OWN_FAMILIES else round(len(names) ** (1 / 3))
    return {v: f"~{names[i - i % size]}" for i, v in enumerate(names)}


def fit(docs: DataFrame, families: Mapping[str, list[str]] = FAMILIES, *, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel:
    """Fit on a bounded sample of labelled rows of ``docs``.

    About ``per_language`` documents of each language, those whose hashed id
    and text is lowest, have their texts profiled where they are read; the
    profiles (a few kB each) reach the driver. All labels but null are
    learned; with more than ``SAMPLE / per_language`` of them each has fewer
    documents (``LEAST_PER_LANGUAGE`` at least), so that the sample stays
    bounded. Languages of no listed family are families of their own, or, if
    more than ``OWN_FAMILIES``, share families of neighbouring names (see
    :func:`unlisted_families`).
    """
    label = F.col(lang_col).cast("string")
    rows = docs.where(label.isNotNull()).select(
        label.alias("lang"), text_or_empty(text_col).alias("text"),
        F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.length(text_col), F.lit(4)), 11).alias("h"))
    rows = rows.where(F.length("text") > 0)
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .orderBy("lang").collect()}
    if not counts:
        return LanguageModel([], [], {}, {})
    per_language = min(per_language, max(LEAST_PER_LANGUAGE, SAMPLE // len(counts)))
    bound = F.create_map(*[F.lit(v) for k, n in counts.items()
                           for v in (k, int(min(1.0, per_language / n) * 2 ** 53))])

    def profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, h, raw in zip(batch["lang"], batch["h"], batch["text"].cast(pa.binary())):
                p = _profile(raw.as_py())
                at = np.flatnonzero(p).astype(np.int32)
                out.append((lang.as_py(), h.as_py(), at.tobytes(), p[at].tobytes()))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("lang", "h", "at", "share"), r)) for r in out],
                pa.schema([("lang", pa.string()), ("h", pa.int64()), ("at", pa.binary()), ("share", pa.binary())]))

    sample = (rows.where(F.col("h") < bound[F.col("lang")])
              .mapInArrow(profiles, "lang string, h long, at binary, share binary").toPandas()
              .sort_values(["lang", "h", "share"], kind="stable"))
    sample = sample.groupby("lang", sort=True).head(int(1.5 * per_language) + 10)
    x = np.zeros((len(sample), len(ORDERS) << FEATURE_BITS), dtype=np.float32)
    for i, (at, share) in enumerate(zip(sample["at"], sample["share"])):
        x[i, np.frombuffer(at, np.int32)] = np.frombuffer(share, np.float32)
    norm = float(np.sqrt((x * x).sum() / len(sample))) or 1.0  # profiles get a mean length of 1
    x /= norm
    langs = sample["lang"].to_numpy()
    learned = sorted(set(langs))
    home = {m: f for f, members in families.items() for m in members}
    home |= unlisted_families([v for v in learned if v not in home])
    groups = [list(g) for _, g in itertools.groupby(sorted(learned, key=lambda v: (home[v], v)),
                                                    key=lambda v: home[v])]

    def svm(plus: list[str], minus: list[str]) -> tuple[np.ndarray, float]:
        a, b = np.isin(langs, plus), np.isin(langs, minus)
        w, bias = fit_svm(x[a | b], np.where(a[a | b], 1.0, -1.0))
        return w / np.float32(norm), bias

    between = {(i, j): svm(groups[i], groups[j]) for i, j in itertools.combinations(range(len(groups)), 2)}
    within = {(a, b): svm([a], [b]) for g in groups for a, b in itertools.combinations(g, 2)}
    return LanguageModel(learned, groups, between, within)



def identify(docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of each row, from its whole text alone.

    A text that is null or has no letter is ``und`` with score 0, and so is
    every text if no language was learned. Rows pass unshuffled, repeated
    ones and null ids too; other columns are ignored. The model, a few
    weights for each pair of classes, goes with the tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most some hundred kB for each pair

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            letters = np.asarray(batch["letter"].to_numpy(zero_copy_only=False), dtype=bool)
            if own.languages:
                names, scores = own.predict(*text_buffer(batch["text"]))
            else:
                names, scores = np.full(len(letters), UNKNOWN, object), np.zeros(len(letters))
            names[~letters], scores[~letters] = UNKNOWN, 0.0
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(names, pa.string()), pa.array(scores)],
                                             names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"),
                       text_or_empty(text_col).rlike(r"\p{L}").alias("letter"))
    return rows.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, lang_pred string, score double")


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from fitting: its id's CRC-32 is divisible by ``HELD_OUT``."""
    return F.pmod(id_crc(id_col), F.lit(HELD_OUT)) == 0


def drop_unidentified(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                      lang_col: str = "lang", sure: float = SURE) -> DataFrame:
    """``docs`` without the rows that have no language, their language column set by prediction; unshuffled.

    Fits on the labelled rows of ``docs`` that are not held out and predicts
    every whole text. A row whose text is null or has no letter goes. Of the
    others, one without a label gets the predicted language, and one whose
    label differs gets it if the prediction's score is at least ``sure``;
    other columns are unchanged. If no language was learned, labels stay.
    The texts stay in their rows: the prediction is made in each batch.
    """
    model = fit(docs.where(~held_out(id_col)), id_col=id_col, text_col=text_col, lang_col=lang_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema, at, lang = docs.schema, docs.columns.index(text_col), docs.columns.index(lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            keep = batch.column(batch.num_columns - 1)
            kept = batch.select(list(range(batch.num_columns - 1)))
            if own.languages and len(kept):
                names, scores = own.predict(*text_buffer(kept.column(at).fill_null("")))
                labels = np.array(kept.column(lang).to_pylist(), dtype=object)
                bare = np.array([x is None for x in labels])
                chosen = np.where((names != UNKNOWN) & (bare | (scores >= sure)), names, labels)
                kept = kept.set_column(lang, kept.schema.field(lang), pa.array(chosen, kept.schema.field(lang).type))
            yield kept.filter(keep)

    flagged = docs.select("*", text_or_empty(text_col).rlike(r"\p{L}").alias("__letter"))
    return flagged.mapInArrow(run, schema)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those that are not held out."""
    docs = load(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    found = identify(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
