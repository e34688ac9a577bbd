"""Byte-pair encoding with word ends, and decoding, from a public tokenizer's file."""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import load, text_or_empty

TOKENIZER = "word_bpe_49k.json"
CACHED_WORDS = 200_000  # of each of the two generations of a worker's memo


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Place of an installed public tokenizer file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others, in order, take
    the code points from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordBpe:
    """Encoder and decoder of one tokenizer file (lower case, byte letters, word-end mark)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.specials.items()}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # \s of the file's regex dialect is Unicode's White_Space
        self.words = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")).findall
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")").split
        end = model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.inner = [self.vocab.get(letters[b]) for b in range(256)]
        self.last = [self.vocab.get(letters[b] + end) for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])

    def encode_word(self, word: str) -> list[int]:
        """Merge the symbols of one word, the lowest rank first, the leftmost of equal rank first.

        Symbols form a doubly linked list; a queue holds the possible merges.
        An entry whose two symbols have changed since is stale and skipped.
        """
        raw = word.encode("utf-8")
        table = self.inner
        sym = [table[b] for b in raw]
        sym[-1] = self.last[raw[-1]]
        if None in sym:  # a byte that the vocabulary lacks has no token
            sym = [s for s in sym if s is not None]
        n = len(sym)
        merges, push, pop = self.merges, heapq.heappush, heapq.heappop
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            m = merges.get((sym[i], sym[i + 1]))
            if m is not None:
                queue.append((m[0], i, sym[i], sym[i + 1], m[1]))
        heapq.heapify(queue)
        while queue:
            _, i, a, b, new = pop(queue)
            if sym[i] != a:
                continue
            j = nxt[i]
            if j >= n or sym[j] != b:
                continue
            sym[i], sym[j] = new, -1
            k = nxt[i] = nxt[j]
            if k < n:
                prv[k] = i
                m = merges.get((new, sym[k]))
                if m is not None:
                    push(queue, (m[0], i, new, sym[k], m[1]))
            h = prv[i]
            if h >= 0:
                m = merges.get((sym[h], new))
                if m is not None:
                    push(queue, (m[0], h, sym[h], new, m[1]))
        return [s for s in sym if s != -1]

    def pieces(self, text: str) -> list[str | int]:
        """Words of the normalised text in order, and the ids of special tokens written in it."""
        out: list[str | int] = []
        parts = self.special_split(text) if "<|" in text else [text]
        for part in parts:
            if part in self.specials:
                out.append(self.specials[part])
            elif part:
                # lower case letter by letter: a capital sigma has one small form
                out += self.words(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())
        return out

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for p in self.pieces(text):
            ids += [p] if isinstance(p, int) else self.encode_word(p)
        return ids

    def decode(self, ids: list[int]) -> str:
        """The vocabulary strings in order, a space between; this file's tokens carry no joiner."""
        return " ".join([self.strings[i] for i in ids if i in self.strings])


class _Memo(dict):
    """Word to (ids, decoded text), both joined by spaces; bounded by two generations."""

    def __init__(self, bpe: WordBpe, limit: int):
        super().__init__()
        self.bpe, self.limit, self.old = bpe, limit, {}

    def __missing__(self, piece: str | int) -> tuple[str, str]:
        got = self.old.get(piece)
        if got is None:
            ids = [piece] if isinstance(piece, int) else self.bpe.encode_word(piece)
            got = " ".join(map(str, ids)), self.bpe.decode(ids)
        if len(piece if isinstance(piece, str) else "") <= 64:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[piece] = got
        return got


_LOADED: dict[str, _Memo] = {}  # of this Python worker


def _memo(path: str) -> _Memo:
    if path not in _LOADED:
        _LOADED[path] = _Memo(WordBpe(path), CACHED_WORDS)
    return _LOADED[path]


def encode_documents(docs: DataFrame, *, path: str | None = None, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of each row's whole text.

    A null or empty text has no ids. Every row, repeated or with a null id,
    gives one row; other columns are ignored.
    """
    path = path or tokenizer_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = _memo(path)
        for pdf in batches:
            ids = [[int(i) for w in memo.bpe.pieces(t) for i in memo[w][0].split()] for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "ids": ids})

    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInPandas(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, ids array<int>")


def decode_documents(encoded: DataFrame, *, path: str | None = None) -> DataFrame:
    """doc_id and text of (doc_id, ids) rows; null ids give a null text."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = _memo(path).bpe
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"],
                                "text": [None if i is None else bpe.decode(list(i)) for i in pdf["ids"]]})

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInPandas(run, f"doc_id {kind}, text string")


def token_digests(docs: DataFrame, *, path: str | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row's whole text.

    Encodes and decodes each document where it is read, so neither ids nor
    texts are sent on: only their digests. As :func:`encode_documents` for
    nulls; the digests of no ids are those of the empty text.
    """
    path = path or tokenizer_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = _memo(path)
        pieces, sha = memo.bpe.pieces, hashlib.sha256
        for pdf in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in pdf["text"]:
                got = [memo[w] for w in pieces(text)]
                ids = " ".join([g[0] for g in got if g[0]])
                counts.append(ids.count(" ") + 1 if ids else 0)
                ids_sha.append(sha(ids.encode("ascii")).hexdigest())
                text_sha.append(sha(" ".join([g[1] for g in got if g[0]]).encode("utf-8")).hexdigest())
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": counts, "ids_sha256": ids_sha,
                                "decoded_sha256": text_sha})

    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInPandas(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    return token_digests(load(spark, sf_dir, "documents"))
