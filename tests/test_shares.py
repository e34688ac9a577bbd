"""Log-analysis shares on the status-log fixtures and edge cases."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.functions import field, split_fields
from tessera.operators import affected_share, format_share_lines, topk_share, value_share
from tessera.sources import fields_table, lines_frame

# Fixture lines "<id> <page> <status>" (status log 1).
STATUS_LOG_1 = [
    "0 /pagina.html 200", "1 /pagina.html 200", "2 /pagina.html 500", "3 /pagina.html 500",
    "4 /pagina.html 500", "5 /pagina.html 500", "6 /pagina.html 401", "7 /pagina.html 403",
    "8 /pagina.html 403", "9 /pagina.html 201",
]
# "<id> <ip>" and a second status log keyed by the same ids.
ADDRESSES = [
    "1 10.0.0.1", "2 10.0.0.2", "3 10.0.0.1", "4 10.0.0.3", "5 10.0.0.1",
    "6 10.0.0.1", "7 10.0.0.4", "8 10.0.0.5", "9 10.0.0.5", "10 10.0.0.6",
]
STATUS_LOG_2 = [
    "1 /pagina.html 401", "2 /pagina.html 401", "3 /pagina.html 401", "4 /pagina.html 401",
    "5 /pagina.html 401", "6 /pagina.html 200", "7 /pagina.html 200", "8 /pagina.html 200",
    "9 /pagina.html 404", "10 /pagina.html 500",
]
PAGE_LOG = [
    "1 /comprar 200", "2 /comprar 200", "3 /comprar 200", "4 /listar 200", "5 /listar 200",
    "6 /ver 200", "7 /ver 200", "8 /excluir 200", "9 /excluir 200", "10 /teste 501",
    "11 /teste 200", "12 /listrr 404",
]


def parse(spark, lines, names):
    return fields_table(lines_frame(spark, lines), names)


def test_value_share_status_log(spark):
    log = parse(spark, STATUS_LOG_1, ["id", "page", "status"])
    got = [tuple(r) for r in value_share(log, "status", ["200", "500", "401"]).collect()]
    assert got == [("200", 0.2), ("500", 0.4), ("401", 0.1)]


def test_value_share_is_one_aggregate(spark):
    log = parse(spark, STATUS_LOG_1, ["id", "page", "status"])
    plan = value_share(log, "status", ["200", "500"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and "partial_count" in plan


def test_value_share_empty_table_gives_null(spark):
    empty = spark.createDataFrame([], "status string")
    got = [tuple(r) for r in value_share(empty, "status", ["200"]).collect()]
    assert got == [("200", None)]


def test_affected_share_fixture(spark):
    status = parse(spark, STATUS_LOG_2, ["id", "page", "status"])
    addr = parse(spark, ADDRESSES, ["id", "ip"])
    got = affected_share(status, addr, "id", "status", "401", "id", "ip").first()
    assert (got.n_affected, got.n_total, got.share) == (3, 6, 0.5)


def test_affected_share_duplicate_status_rows_do_not_multiply(spark):
    status = spark.createDataFrame([("1", "401")] * 50 + [("2", "200")], "id string, status string")
    addr = spark.createDataFrame([("1", "a"), ("2", "b"), (None, "c"), ("3", None)], "id string, ip string")
    got = affected_share(status, addr, "id", "status", "401", "id", "ip").first()
    assert (got.n_affected, got.n_total) == (1, 3)


def test_topk_share_page_log(spark):
    log = parse(spark, PAGE_LOG, ["id", "page", "status"])
    got = [tuple(r) for r in topk_share(log, "page", 5).collect()]
    assert got[0] == ("/comprar", 3, 0.25)
    assert [g[0] for g in got[1:]] == ["/excluir", "/listar", "/teste", "/ver"]
    assert all(g[1] == 2 and g[2] == pytest.approx(2 / 12) for g in got[1:])


def test_short_row_strict_raises_permissive_nulls(spark):
    lines = lines_frame(spark, ["1 /a 200", "2 /b"])
    strict = lines.select(field(split_fields("value"), 2).alias("s"))
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        strict.collect()
    loose = lines.select(field(split_fields("value"), 2, strict=False).alias("s"))
    assert sorted((r.s for r in loose.collect()), key=str) == sorted([None, "200"], key=str)


def test_split_trailing_separator(spark):
    df = lines_frame(spark, ["a b "])
    assert df.select(split_fields("value")).first()[0] == ["a", "b", ""]
    assert df.select(split_fields("value", java_trailing=True)).first()[0] == ["a", "b"]


def test_split_like_the_jvm(spark):
    lines = ["a b ", "    ", "", " a", "a  b"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string")
    got = [r[0] for r in df.orderBy("i").select(split_fields("value", java_trailing=True)).collect()]
    assert got == [["a", "b"], [], [""], ["", "a"], ["a", "", "b"]]


def test_topk_share_counts_null_keys_in_total(spark):
    df = spark.createDataFrame([("x",), ("x",), (None,), ("y",)], "k string")
    got = rows(topk_share(df, "k", 1))
    assert got == [("x", 2, 0.5)]


def test_fields_table_skips_and_permissive(spark):
    lines = lines_frame(spark, ["1 /a 200", "2 /b"])
    got = rows(fields_table(lines, ["id", None, "status"], strict=False))
    assert got == sorted([("1", "200"), ("2", None)], key=str)


def test_share_lines(spark):
    log = parse(spark, PAGE_LOG, ["id", "page", "status"])
    first = format_share_lines(topk_share(log, "page", 1), "page").first().line
    assert first == "/comprar 3 0.25"


@pytest.mark.parametrize("n", [1, 32, 33, 500])
@pytest.mark.parametrize("kind", ["int", "string", "double"])
def test_value_share_is_one_path_for_any_list(spark, n, kind):
    df = spark.createDataFrame([(i % 70,) for i in range(1000)] + [(None,)], "s int").select(F.col("s").cast(kind))
    wanted = spark.range(n).select(F.col("id").cast(kind).alias("w"))
    counts = {r.s: r["count"] for r in df.groupBy("s").count().collect()}
    out = value_share(df, "s", [r.w for r in wanted.collect()])
    assert out.dtypes == [("s", kind), ("share", "double")]
    assert [tuple(r) for r in out.collect()] == [(r.w, counts.get(r.w, 0) / 1001) for r in wanted.collect()]


def test_value_share_of_a_value_the_type_cannot_hold(spark):
    df = spark.createDataFrame([(2,), (2,), (3,), (None,)], "s int")
    assert [tuple(r) for r in value_share(df, "s", ["2", "x", "3", "2"]).collect()] == [
        (2, 0.5), (None, 0.0), (3, 0.25), (2, 0.5)]
