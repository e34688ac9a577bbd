"""Registered queries: names, columns, SQL; and the rest without this subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from conftest import ROOT, SF_SMALL
from tessera.llm.catalog import ORACLE, REGISTRY
from tools.check_oracle import compare, duck

COLUMNS = {
    1: "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    2: "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    3: "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    4: "doc_id bigint, held_out boolean, lang_pred string, score double",
    5: "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
       "score double",
    6: "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    7: "doc_id bigint, fingerprint string, component_id bigint",
    8: "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    9: "query_id bigint, rank int, vec_id bigint, score double",
    10: "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    11: "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
        "saved_tokens bigint, ends_sha256 string",
    12: "doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint",
    13: "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
}


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14))
    assert set(ORACLE) <= set(REGISTRY) < set(entry.queries()) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_columns_and_sql(spark, name):
    n = int(name[2:].split("_")[0])
    if name in ORACLE:
        r = compare(spark, name, REGISTRY[name], ORACLE[name], SF_SMALL, duck(SF_SMALL))
        assert r["cols"] and r["types"] and r["exact"], (r["s_sample"], r["d_sample"])
    df = REGISTRY[name](spark, SF_SMALL)
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == COLUMNS[n]


def test_the_rest_stands_without_this_subpackage(tmp_path):
    for name in ("tessera", "tools", "tests", "__spark_entry__.py", "bench.py"):
        source = os.path.join(ROOT, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=lambda d, names: [n for n in names if n in ("llm", "__pycache__")])
        else:
            shutil.copy(source, tmp_path / name)
    code = ("import __spark_entry__ as e, re; q = e.queries(); "
            "assert 'word_count' in q and 'pipeline' not in q and not any(re.match(r'op\\d', n) for n in q)")
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
    subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", "tests"], cwd=tmp_path, check=True)
