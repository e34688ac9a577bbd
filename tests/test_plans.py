"""Physical-plan guards: the properties the jobs rely on at scale."""

import pytest

from conftest import SF_SMALL
from tessera.plans import REGISTRY

QUERIES = REGISTRY
STREAMS = {n for n in REGISTRY if n.endswith("_stream")} | {"incremental_line_count"}  # their frames read what was written
BATCH = sorted(set(REGISTRY) - STREAMS)
BY_HAND = {"failure_streak_health", "trailing_topn_series", "choices_over_time"}  # sweep chunks of rows in Python


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {n: plan_text(QUERIES[n](spark, SF_SMALL)) for n in BATCH}


@pytest.mark.parametrize("name", sorted(set(BATCH) - BY_HAND))
def test_no_product_join_and_no_python(plans, name):
    p = plans[name]
    assert "RoundRobinPartitioning" not in p
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in p, f"{name} uses {bad}"


@pytest.mark.parametrize("name", BATCH)
def test_scans_read_only_needed_columns(plans, name):
    # documents has five columns, events six, customer five: a job never reads them all
    for line in plans[name].splitlines():
        if "FileScan parquet" in line and "documents.parquet" in line:
            assert "ReadSchema: struct<text:string>" in line, line
        if "FileScan parquet" in line and "events.parquet" in line:
            assert "props" not in line.split("ReadSchema")[-1], line


@pytest.mark.parametrize("name", ["trailing_topn_avg", "cheapest_under_limit"])
def test_top_n_is_limited_before_the_shuffle(plans, name):
    assert "WindowGroupLimit" in plans[name] and "Partial" in plans[name]


@pytest.mark.parametrize("name,needle", [
    ("trailing_topn_avg", "GreaterThanOrEqual(ts,"),
    ("affected_share", "EqualTo(o_orderstatus,P)"),
])
def test_filters_reach_the_scan(plans, name, needle):
    assert needle in plans[name]


def test_word_count_aggregates_before_shuffle(plans):
    p = plans["word_count"]
    assert "partial_count" in p


def test_topk_uses_take_ordered(plans):
    assert "TakeOrderedAndProject" in plans["word_count_topk"]
    assert "TakeOrderedAndProject" in plans["topk_share"]


def test_value_share_scans_once(plans):
    assert plans["value_share"].count("FileScan parquet") == 1
