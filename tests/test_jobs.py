"""Named jobs over raw lines, with the fixtures of the original samples."""

import hashlib
import itertools

from conftest import rows
from tessera.plans import jobs
from tessera.sources import lines_frame

from test_shares import ADDRESSES, PAGE_LOG, STATUS_LOG_1, STATUS_LOG_2
from test_sources import write_day
from test_text import NAMES, VERSE, VERSE_COUNTS


def test_status_share(spark):
    got = [tuple(r) for r in jobs.status_share(lines_frame(spark, STATUS_LOG_1)).collect()]
    assert got == [("200", 0.2), ("500", 0.4), ("401", 0.1)]


def test_affected_ip_share(spark):
    r = jobs.affected_ip_share(lines_frame(spark, STATUS_LOG_2), lines_frame(spark, ADDRESSES)).first()
    assert r.share == 0.5


def test_top_pages_share(spark):
    got = [tuple(r)[:2] for r in jobs.top_pages_share(lines_frame(spark, PAGE_LOG)).collect()]
    assert got == [("/comprar", 3), ("/excluir", 2), ("/listar", 2), ("/teste", 2), ("/ver", 2)]


def test_words_and_anagrams(spark):
    assert dict(jobs.line_word_count(lines_frame(spark, VERSE)).collect()) == VERSE_COUNTS
    assert jobs.line_top_words(lines_frame(spark, VERSE), 1).first().word == "she"
    assert len(rows(jobs.line_anagram_groups(lines_frame(spark, NAMES)))) == 3


def test_digest_pair_match(spark):
    pairs = spark.createDataFrame(list(itertools.product(["u1", "u2"], ["p1", "p2"])), "a string, b string")
    digest = hashlib.md5(b"u2:p1").hexdigest()
    got = rows(jobs.digest_pair_match(pairs, lines_frame(spark, [digest, "    "])))
    assert got == [("u2", "p1", digest)]


def test_completed_line_count(spark, scratch):
    write_day(spark, scratch, "2014-05-01", ["a", "b"])
    write_day(spark, scratch, "2014-05-02", ["c"])
    write_day(spark, scratch, "2014-05-03", ["d"], complete=False)
    assert jobs.completed_line_count(spark, scratch).first().n_lines == 3
    assert jobs.completed_line_count(spark, scratch, date_from="2014-05-02").first().n_lines == 1
