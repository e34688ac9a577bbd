"""Text jobs: word count, ranked top-k, anagram groups, line count."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.functions import anagram_key, word_tokens
from tessera.operators import (
    anagram_groups, anagram_members, format_ranked, line_count, top_words, word_count, word_count_topk,
)
from tessera.sources import document_lines, lines_frame

# A short verse of four lines, framed by an empty first line and a last line
# of six spaces (the unit-test input of the word count).
VERSE = [
    "",
    "She sells sea-shells on the sea-shore.",
    "The shells she sells are sea-shells, I'm sure.",
    "For if she sells sea-shells on the sea-shore",
    "Then I'm sure she sells sea-shore shells.",
    "      ",
]
VERSE_COUNTS = {
    "are": 1, "sea-shells": 3, "if": 1, "on": 2, "shells": 2, "then": 1, "sure": 2,
    "she": 4, "for": 1, "i'm": 2, "sea-shore": 3, "sells": 4, "the": 3,
}

NAMES = ["roseboro", "bororose", "howlet", "telwoh", "aless", "sales", "xyz"]


def test_word_count_verse(spark):
    got = dict(word_count(lines_frame(spark, VERSE)).collect())
    assert got == VERSE_COUNTS


def test_word_count_types_and_empty(spark):
    df = word_count(spark.createDataFrame([], "value string"))
    assert df.count() == 0
    assert dict(df.dtypes) == {"word": "string", "cnt": "bigint"}


def test_word_count_null_and_unicode(spark):
    lines = spark.createDataFrame([(None,), ("Ça va? ÇA VA! naïve-- ' 42 x1y",)], "value string")
    got = dict(word_count(lines).collect())
    assert got == {"ça": 2, "va": 2, "naïve--": 1, "'": 1, "x": 1, "y": 1}


def test_word_tokens_column(spark):
    df = spark.createDataFrame([("Hello, World-wide o'clock",)], "value string")
    assert df.select(word_tokens("value")).first()[0] == ["hello", "world-wide", "o'clock"]


def test_top_words_ties_go_word_descending(spark):
    counts = spark.createDataFrame([("a", 2), ("b", 2), ("c", 5), ("d", 1)], "word string, cnt bigint")
    got = [tuple(r) for r in top_words(counts, k=3).collect()]
    assert got == [(1, "c", 5), (2, "b", 2), (3, "a", 2)]


def test_word_count_topk_verse(spark):
    got = [tuple(r) for r in word_count_topk(lines_frame(spark, VERSE), k=4).collect()]
    assert got == [(1, "she", 4), (2, "sells", 4), (3, "the", 3), (4, "sea-shore", 3)]
    text = [r[0] for r in format_ranked(word_count_topk(lines_frame(spark, VERSE), k=1)).collect()]
    assert text == ["1) 4 - 'she'"]


def test_anagram_groups_names(spark):
    got = rows(anagram_groups(lines_frame(spark, NAMES)))
    assert got == [("aless sales",), ("bororose roseboro",), ("howlet telwoh",)]


def test_anagram_groups_case_sensitive_and_duplicates(spark):
    lines = ["listen Silent silent", "enlist listen", "", "a a"]
    got = rows(anagram_groups(lines_frame(spark, lines)))
    assert got == [("enlist listen silent",)]


def test_anagram_key(spark):
    df = spark.createDataFrame([("bororose",), ("",)], "w string")
    assert [r[0] for r in df.select(anagram_key("w")).collect()] == ["beooorrs", ""]


def test_line_count_lines_and_documents(spark):
    assert line_count(lines_frame(spark, VERSE)).first()["n_lines"] == 6
    docs = spark.createDataFrame([("a\nb\n",), ("c",), (None,)], "text string")
    assert line_count(docs, "text", whole_documents=True).first()["n_lines"] == 3
    assert document_lines(docs, "text").count() == 3


def test_word_count_on_documents_matches_lines(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a = rows(word_count(docs, "text"))
    b = rows(word_count(document_lines(docs, "text")))
    assert a == b and len(a) > 100


@pytest.mark.parametrize("k", [1, 10])
def test_topk_is_prefix_of_full_sort(spark, k):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    full = word_count(docs, "text").orderBy(F.desc("cnt"), F.desc("word")).collect()
    top = word_count_topk(docs, k, "text").collect()
    assert [(r.word, r.cnt) for r in top] == [(r.word, r.cnt) for r in full[:k]]


@pytest.mark.parametrize("text,n", [("a", 1), ("a\n", 1), ("a\n\n", 2), ("\n", 1), ("", 0), ("a\nb", 2), (None, 0)])
def test_lines_are_those_of_a_text_read(spark, text, n):
    from tessera.sources import document_lines
    df = spark.createDataFrame([(text,)], "text string")
    assert line_count(df, "text", whole_documents=True).first().n_lines == n
    assert document_lines(df).count() == n


def test_anagram_members_same_groups_as_joined_form(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    joined = sorted(r.words for r in anagram_groups(docs, "text", whole_documents=True).collect())
    members = {}
    for r in anagram_members(docs, "text", whole_documents=True).collect():
        members.setdefault(r.anagram_key, []).append(r.word)
    assert sorted(" ".join(sorted(ws)) for ws in members.values()) == joined
    assert len(joined) > 10
