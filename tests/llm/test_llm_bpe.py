"""Byte-pair encoding against the tokenizers library, and its decoding."""

import hashlib
import random
import unicodedata

import pytest
from tokenizers import Tokenizer

from tessera.llm import bpe

from llm_helpers import nothing, odd  # noqa: F401

LIB = Tokenizer.from_file(bpe.tokenizer_path())
OWN = bpe.WordBpe(bpe.tokenizer_path())

FIXED = ["ΑΣ Σ ΟΔΟΣ", "İstanbul", "<|endoftext|>a<|startoftext|> b<|endoftext", "\x1c a\x1fb\x85c d​e　f",
         "'S'T don't I'LL 's's", "é é", "123 45a6", "a" * 3000, "", " ", "…¿¡", "\U0001f600x", "ﬁ Ⅷ ²",
         "áb", " ﻿x", "ǅ ẞ ß", "ͅ"]


def expected(text):
    ids = LIB.encode(text, add_special_tokens=False).ids
    return ids, LIB.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", FIXED)
def test_fixed_texts(text):
    ids, back = expected(text)
    assert OWN.encode(text) == ids and OWN.decode(ids) == back


def test_random_letters():
    rnd = random.Random(1)
    alphabet = [chr(c) for a, b in ((0, 0x250), (0x370, 0x400), (0x1E00, 0x2100), (0xAC00, 0xAC20), (0x1F600, 0x1F610))
                for c in range(a, b) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    for _ in range(2000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 30)))
        assert OWN.encode(text) == expected(text)[0], ascii(text)


def test_stale_entries_are_skipped():
    # the pair "a a" overlaps itself: only every second one can merge
    assert OWN.encode("aaaaaaa") == expected("aaaaaaa")[0]


def test_documents_and_odd_rows(spark, odd, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for df in (docs, odd):
        rows = df.select("doc_id", "text").collect()
        want = []
        for r in rows:
            ids, back = expected(r.text or "")
            want.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(back.encode()).hexdigest()))
        key = lambda x: (x[0] is None, x[0] or 0, x[1:])
        assert sorted(map(tuple, bpe.token_digests(df).collect()), key=key) == sorted(want, key=key)
    assert bpe.token_digests(nothing).collect() == []


def test_ids_and_round_trip(spark, odd):
    encoded = bpe.encode_documents(odd.where("doc_id < 10"))
    texts = {r.doc_id: r.text for r in odd.collect()}
    for r in encoded.collect():
        assert r.ids == expected(texts[r.doc_id] or "")[0]
    for r in bpe.decode_documents(encoded).collect():
        assert r.text == expected(texts[r.doc_id] or "")[1]


def test_the_memo_stays_bounded():
    memo = bpe._Memo(OWN, 10)
    for i in range(100):
        assert memo[f"word{i % 37}"][0] == " ".join(map(str, OWN.encode_word(f"word{i % 37}")))
    assert len(memo) <= 10 and len(memo.old) <= 10
