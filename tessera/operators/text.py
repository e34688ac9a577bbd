"""Text jobs: line count, word count, ranked top-k words, anagram groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import (
    FIELD_SEPARATOR, LINE_SEPARATOR, WORD_PATTERN, anagram_key, joined_sorted,
    n_lines, split_fields,
)
from tessera.session import scratch


def line_count(df: DataFrame, text_col: str = "value", whole_documents: bool = False) -> DataFrame:
    """Number of lines: one row ``n_lines``.

    On a line table (``spark.read.text``) every row is a line. With
    ``whole_documents`` each row holds a whole text and its lines are
    counted as a text read would: a final line break starts no further
    line, an empty or null text has none.
    """
    if whole_documents:
        per_row = F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(n_lines(text_col))
        n = F.sum(per_row.cast("bigint"))
        return df.agg(F.coalesce(n, F.lit(0).cast("bigint")).alias("n_lines"))
    return df.agg(F.count(F.lit(1)).alias("n_lines"))


def words(df: DataFrame, text_col: str = "value", pattern: str = WORD_PATTERN) -> DataFrame:
    """One row per word occurrence (``word``), lower-cased.

    The regex find-all runs on each text as is: the word pattern never spans
    a line break, so whole documents need no line split first. ``lower`` is
    applied after ``explode`` so it stays a plain codegen expression.
    """
    found = F.regexp_extract_all(F.col(text_col), F.lit(pattern), F.lit(0))
    return df.select(F.explode(found).alias("w")).select(F.lower("w").alias("word"))


def word_count(df: DataFrame, text_col: str = "value", pattern: str = WORD_PATTERN) -> DataFrame:
    """``(word, cnt)`` for every distinct lower-cased word.

    Planned as a partial hash aggregate per input split, one shuffle on
    ``word``, and a final aggregate: a frequent word sends one partial count
    per task, never its occurrences.
    """
    return words(df, text_col, pattern).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def top_words(counts: DataFrame, k: int = 1000, word_col: str = "word",
              cnt_col: str = "cnt") -> DataFrame:
    """The k most frequent words with their 1-based rank ``rnk``.

    Order is count descending, then word descending (a tuple ``top``).
    ``orderBy().limit(k)`` is planned as ``TakeOrderedAndProject``: each task
    keeps its best k, so no full sort happens; the rank is then numbered over
    those k rows only.
    """
    order = [F.desc(cnt_col), F.desc(word_col)]
    top = counts.orderBy(*order).limit(k)
    rank = F.row_number().over(Window.orderBy(*order)).cast("bigint")
    return top.select(rank.alias("rnk"), word_col, cnt_col)


def word_count_topk(df: DataFrame, k: int = 1000, text_col: str = "value") -> DataFrame:
    return top_words(word_count(df, text_col), k)


def format_ranked(ranked: DataFrame) -> DataFrame:
    """Text form of a ranked row: ``<rank>) <count> - '<word>'``."""
    return ranked.select(F.format_string("%d) %d - '%s'", "rnk", "cnt", "word").alias("line"))


def anagram_groups(df: DataFrame, text_col: str = "value", sep: str = FIELD_SEPARATOR,
                   whole_documents: bool = False) -> DataFrame:
    """Groups of two or more distinct tokens that are anagrams (``words``).

    Tokens are the parts of a line split on ``sep``; with ``whole_documents``
    line breaks separate tokens as well. Case-sensitive. Members are joined
    by one space in ascending order.

    Tokens are made distinct first (partial aggregate per task, then one
    shuffle on the token), so the anagram key is computed once per distinct
    token, and a key's list only ever holds distinct tokens: bounded by the
    vocabulary, not by occurrences. Tokens that are alone under their key
    (the empty one always is) are dropped by a partial count before anything
    is gathered. Each group is one output row, so a group is gathered in one
    task; ``anagram_members`` gives the same groups without gathering them.
    """
    members = anagram_members(df, text_col, sep, whole_documents)
    grouped = members.groupBy("anagram_key").agg(F.collect_list("word").alias("ws"))
    return grouped.select(joined_sorted("ws").alias("words"))


def anagram_members(df: DataFrame, text_col: str = "value", sep: str = FIELD_SEPARATOR,
                    whole_documents: bool = False) -> DataFrame:
    """The members of the anagram groups in long form: ``(anagram_key, word)``.

    Same groups as ``anagram_groups``, one row per member, and no group is
    ever gathered into one row: group sizes come from a partial count per
    key, and members are kept by a join on the key (AQE splits a hot key's
    side). Use this form when one key may hold a large share of all tokens.
    The distinct tokens, which both sides need, are written to the shared
    folder, so that the texts are read once.
    """
    path = scratch(df.sparkSession)
    (_distinct_tokens(df, text_col, sep, whole_documents)
     .select(anagram_key("w").alias("anagram_key"), F.col("w").alias("word")).write.parquet(path))
    tokens = df.sparkSession.read.schema("anagram_key string, word string").parquet(path)
    sizes = tokens.groupBy("anagram_key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return tokens.join(sizes.select("anagram_key"), "anagram_key", "left_semi")


def _distinct_tokens(df: DataFrame, text_col: str, sep: str, whole_documents: bool) -> DataFrame:
    text = F.col(text_col)
    if whole_documents:
        # a line break separates tokens like ``sep`` does: map it onto ``sep``
        # so the split stays on one literal character (no regex engine)
        text = F.translate(text, LINE_SEPARATOR, sep) if len(sep) == 1 else F.replace(
            text, F.lit(LINE_SEPARATOR), F.lit(sep))
    return df.select(F.explode(split_fields(text, sep)).alias("w")).distinct()
