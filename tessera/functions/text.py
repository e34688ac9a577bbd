"""Column expressions for text: tokens, fields, anagram keys, digests.

All of these are built-in Spark SQL expressions, so they stay inside
whole-stage codegen; none needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that define results (they must stay exactly as written):
# a word is a run of Unicode letters, apostrophes and hyphens; fields of a
# log line are separated by one space; a pair is rendered "a:b" before it
# is digested; anagram-group members are joined by one space.
WORD_PATTERN = r"[\p{L}'-]+"
FIELD_SEPARATOR = " "
PAIR_SEPARATOR = ":"
GROUP_SEPARATOR = " "
LINE_SEPARATOR = "\n"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word_tokens(text: str | Column, pattern: str = WORD_PATTERN) -> Column:
    """Array of lower-cased words found in ``text`` (regex find-all).

    Group index 0 is the whole match, so the pattern needs no capture group.
    A bare ``-`` or ``'`` is a word too, as in a plain find-all.
    """
    found = F.regexp_extract_all(_col(text), F.lit(pattern), F.lit(0))
    return F.transform(found, lambda w: F.lower(w))


def lines_of(text: str | Column, sep: str = LINE_SEPARATOR) -> Column:
    """Array of the lines of a whole-document string, as a text read gives them.

    A final line break ends the last line and starts no other; an empty text
    has no line.
    """
    parts = F.split(_col(text), sep)
    return F.slice(parts, F.lit(1), F.size(parts) - _open_end(text, sep))


def n_lines(text: str | Column, sep: str = LINE_SEPARATOR) -> Column:
    """Number of :func:`lines_of`, without cutting out the lines."""
    return F.size(F.split(_col(text), sep)) - _open_end(text, sep)


def _open_end(text: str | Column, sep: str) -> Column:
    """1 if the split ends in an empty part that is no line."""
    c = _col(text)
    return F.when(F.endswith(c, F.lit(sep)) | (c == F.lit("")), F.lit(1)).otherwise(F.lit(0))


def split_fields(line: str | Column, sep: str = FIELD_SEPARATOR,
                 java_trailing: bool = False) -> Column:
    """Split a line into its fields on a literal separator.

    Spark keeps trailing empty parts (``"a b "`` gives ``[a, b, ""]``).
    ``java_trailing=True`` drops them, like ``String.split`` on the JVM: a
    line made only of separators then has no part at all, while an empty
    line keeps its one empty part.
    """
    c = _col(line)
    if not java_trailing:
        return F.split(c, _regex_quote(sep))
    stripped = F.regexp_replace(c, "(" + _regex_quote(sep) + ")+$", "")
    only_separators = (stripped == F.lit("")) & (c != F.lit(""))
    return (F.when(only_separators, F.array().cast("array<string>"))
            .otherwise(F.split(stripped, _regex_quote(sep))))


def field(parts: str | Column, i: int, strict: bool = True) -> Column:
    """Field ``i`` (0-based) of a split line.

    ``strict`` raises on a short row (ANSI ``INVALID_ARRAY_INDEX``), like the
    positional access it replaces; otherwise a short row gives null.
    """
    p = _col(parts)
    return p[i] if strict else F.get(p, i)


def anagram_key(word: str | Column) -> Column:
    """The word's characters sorted: equal for all anagrams of a word."""
    return F.concat_ws("", F.sort_array(F.split(_col(word), "")))


def pair_text(a: str | Column, b: str | Column, sep: str = PAIR_SEPARATOR) -> Column:
    """``a<sep>b``; null when either side is null (never a silent skip)."""
    return F.concat(_col(a), F.lit(sep), _col(b))


def pair_digest(a: str | Column, b: str | Column, sep: str = PAIR_SEPARATOR) -> Column:
    """Lower-case hex MD5 of ``a<sep>b`` (UTF-8 bytes)."""
    return F.md5(pair_text(a, b, sep))


def joined_sorted(values: str | Column, sep: str = GROUP_SEPARATOR) -> Column:
    """Members of an array joined in ascending order (``sort_array``: a
    native sort, where ``array_sort`` would run a comparator lambda)."""
    return F.concat_ws(sep, F.sort_array(_col(values)))


def _regex_quote(s: str) -> str:
    special = set(r".^$*+?()[]{}|\\")
    return "".join("\\" + ch if ch in special else ch for ch in s)
