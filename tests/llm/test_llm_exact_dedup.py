"""Exact dedup: codes, exchange, groups, dropping."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import golomb
from tessera.llm.common import merge_counts, pack_sorted, unpack_sorted
from tessera.llm.exact_dedup import drop_exact_duplicates, exact_groups
from tessera.llm.exchange import repeated_fingerprints

from llm_helpers import nothing, odd  # noqa: F401


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2 ** 48 - 1), max_size=60), st.integers(0, 40))
def test_golomb_round_trip(values, k):
    v = np.array(sorted(set(values)), dtype=np.uint64)
    low = int(v[0]) // 2 if len(v) else 0
    k = max(k, golomb.rice_parameter(int(v[-1]) - low if len(v) else 0, len(v)) - 2)  # short unary parts
    assert golomb.decode(golomb.encode(v, low, k), len(v), low, k).tolist() == v.tolist()
    assert unpack_sorted(pack_sorted(v)).tolist() == v.tolist()


def test_merge_counts():
    k, c = merge_counts([np.array([1, 3], np.uint64), np.array([3, 9], np.uint64)], [np.array([1, 2]), np.array([5, 1])])
    assert k.tolist() == [1, 3, 9] and c.tolist() == [1, 7, 1]
    assert merge_counts([], [])[0].tolist() == []


def test_exchange_finds_exactly_the_repeated_values(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 2500 + 10).alias("fp"))
    want = {v for v, n in Counter(r.fp for r in df.collect()).items() if n > 1}
    got = [r.fp for r in repeated_fingerprints(df.repartition(7), 5000, per_owner=100).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows)
    got = exact_groups(docs).collect()
    expected = Counter((i, *want[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) <= {1} and len(kept) == len(want)
    left = drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    assert Counter((r.doc_id, r.text or "") for r in left.collect()) == Counter((k, t) for t, (k, _) in want.items())


def test_documents(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_odd_rows_and_no_rows(spark, odd, nothing):
    check(odd)
    assert exact_groups(nothing).collect() == [] and drop_exact_duplicates(nothing).collect() == []


def test_a_third_of_all_rows_alike(spark):
    check(spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot"))
                                  .otherwise(F.concat(F.lit("t"), F.col("id") % 300)).alias("text")).repartition(5))
