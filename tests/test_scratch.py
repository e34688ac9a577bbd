"""The shared scratch folder: refused without one on a cluster, and cleaned up."""

import types

import pytest

from tessera import session


def test_a_cluster_needs_a_named_folder():
    sc = types.SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077",
                               getConf=lambda: types.SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(types.SimpleNamespace(sparkContext=sc))


def test_scratch_folders_are_deleted(spark):
    path = session.scratch(spark)
    spark.range(3).write.parquet(path)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert fs.exists(p)
    session.drop_folder(spark, path)
    assert not fs.exists(p)
    with pytest.raises(ValueError):
        session.drop_folder(spark, path)


def test_dated_lines_have_few_files_a_day(spark):
    from tessera.plans.catalog import FILES_PER_DAY, q_dated_line_count
    q_dated_line_count(spark, "/root/testdata/sf0.001").collect()
    path = list(session._SCRATCH)[-1]
    files = spark.read.text(path).select("day", "_metadata.file_path").distinct().groupBy("day").count()
    assert files.agg({"count": "max"}).first()[0] <= FILES_PER_DAY


def test_a_table_is_read_with_its_present_columns(spark, scratch):
    from tessera.sources import table
    spark.range(2).write.parquet(f"{scratch}/t.parquet")
    assert table(spark, scratch, "t").columns == ["id"]
    spark.range(2).selectExpr("id", "id as more").write.mode("overwrite").parquet(f"{scratch}/t.parquet")
    assert table(spark, scratch, "t").columns == ["id", "more"]
