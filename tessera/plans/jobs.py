"""Named jobs over raw text lines (``value`` column), as log and text files give them.

Each is a short composition of sources, field parsing and one operator, for
lines laid out as in the original samples: ``<id> <page> <status>`` status
logs, ``<id> <ip>`` address logs, one name or word list per line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tessera.operators import (
    affected_share, anagram_groups, key_rank, line_count, pair_digest_match, topk_share,
    value_share, word_count, word_count_topk,
)
from tessera.sources import fields_table, read_text_dirs

STATUS_FIELDS = ["id", "page", "status"]
ADDRESS_FIELDS = ["id", "ip"]


def completed_line_count(spark: SparkSession, root: str | list[str], pattern: str | None = None,
                         date_from=None, date_to=None) -> DataFrame:
    """Lines of the finished (``_SUCCESS``) folders under ``root``, optionally by date."""
    lines = read_text_dirs(spark, root, pattern, require_success=True,
                           date_from=date_from, date_to=date_to)
    return line_count(lines)


def line_word_count(lines: DataFrame) -> DataFrame:
    return word_count(lines, "value")


def line_top_words(lines: DataFrame, k: int = 1000) -> DataFrame:
    return word_count_topk(lines, k, "value")


def status_share(lines: DataFrame, statuses: Sequence[str] = ("200", "500", "401")) -> DataFrame:
    """Share of all log lines per wanted status (third field)."""
    return value_share(fields_table(lines, [None, None, "status"]), "status", list(statuses))


def affected_ip_share(status_lines: DataFrame, address_lines: DataFrame,
                      status: str = "401") -> DataFrame:
    """Share of distinct addresses whose id has a line with ``status``."""
    st = fields_table(status_lines, ["id", None, "status"])
    addr = fields_table(address_lines, ADDRESS_FIELDS)
    return affected_share(st, addr, "id", "status", status, "id", "ip")


def top_pages_share(lines: DataFrame, k: int = 5) -> DataFrame:
    """The k most requested pages (second field) with their share of all lines."""
    return topk_share(fields_table(lines, [None, "page"]), "page", k)


def ranked_pages(lines: DataFrame) -> DataFrame:
    """Every requested page with its share of all lines and its rank."""
    return key_rank(fields_table(lines, [None, "page"]), "page")


def line_anagram_groups(lines: DataFrame) -> DataFrame:
    return anagram_groups(lines, "value")


def digest_pair_match(pairs: DataFrame, digest_lines: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Pairs (a table of candidate rows) whose ``a:b`` MD5 is one of the digest lines."""
    return pair_digest_match(pairs, digest_lines.withColumnRenamed("value", "digest"), a, b)
