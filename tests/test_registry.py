"""Every registered job against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from conftest import SF_MID, SF_SMALL
from tessera.plans import ORACLE, REGISTRY
from tools.check_oracle import compare, duck


@pytest.fixture(scope="module")
def cons():
    return {SF_SMALL: duck(SF_SMALL), SF_MID: duck(SF_MID)}


def test_every_job_has_an_oracle():
    assert set(REGISTRY) == set(ORACLE)
    assert set(REGISTRY) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


# many small jobs each: on the larger tables only
LONG = {"ttl_exclude_stream", "failure_streak_stream", "choices_over_time", "word_topk_stream", "incremental_line_count"}


@pytest.mark.parametrize("name,sf", [(n, sf) for n in sorted(REGISTRY) for sf in (SF_SMALL, SF_MID)
                                     if sf == SF_MID or n not in LONG])
def test_job_matches_oracle(spark, cons, name, sf):
    r = compare(spark, name, REGISTRY[name], ORACLE[name], sf, cons[sf])
    assert r["cols"], (r["s_cols"], r["d_cols"])
    assert r["types"], (r["s_types"], r["d_types"])
    assert r["spark_rows"] == r["oracle_rows"]
    assert r["exact"], (r["s_sample"], r["d_sample"])


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["rnk", "word", "cnt"]
    assert df.count() > 0
