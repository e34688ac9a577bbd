"""Dated, completed text directories (read side of the line-count job)."""

import datetime as dt

import pytest

from tessera.operators import line_count
from tessera.sources import completed_dirs, in_date_range, path_date, read_text_dirs


def write_day(spark, root, day, lines, complete=True):
    path = f"{root}/{day}"
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    if not complete:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, False)
    return path


def test_path_date_and_range():
    assert path_date("s3a://b/logs/2014-05-01/part-0") == dt.date(2014, 5, 1)
    assert path_date("/x/2014/05/02/y") == dt.date(2014, 5, 2)
    assert path_date("/x/dt=2014-05-03") == dt.date(2014, 5, 3)
    assert path_date("/x/none") is None
    paths = ["/r/2014-05-01", "/r/2014-05-02", "/r/2014-05-03", "/r/undated"]
    assert in_date_range(paths, "2014-05-02", None) == ["/r/2014-05-02", "/r/2014-05-03"]
    assert in_date_range(paths, None, dt.date(2014, 5, 1)) == ["/r/2014-05-01"]
    assert in_date_range(paths) == paths


def test_only_completed_dirs_are_read(spark, scratch):
    write_day(spark, scratch, "2014-05-01", ["a", "b"])
    write_day(spark, scratch, "2014-05-02", ["c"])
    write_day(spark, scratch, "2014-05-03", ["d", "e", "f"], complete=False)
    assert [d.rsplit("/", 1)[1] for d in completed_dirs(spark, scratch)] == ["2014-05-01", "2014-05-02"]
    assert line_count(read_text_dirs(spark, scratch)).first().n_lines == 3
    assert line_count(read_text_dirs(spark, scratch, require_success=False)).first().n_lines == 6


def test_date_pruning_and_date_column(spark, scratch):
    for day, n in (("2014-05-01", 1), ("2014-05-02", 2), ("2014-05-03", 3)):
        write_day(spark, scratch, day, [f"line {i}" for i in range(n)])
    df = read_text_dirs(spark, scratch, date_from="2014-05-02", with_date=True)
    got = sorted((r.date, r.value) for r in df.collect())
    assert [d for d, _ in got] == [dt.date(2014, 5, 2)] * 2 + [dt.date(2014, 5, 3)] * 3
    # the pruned folder never reaches the scan
    files = {f.rsplit("/", 2)[-2] for f in df.inputFiles()}
    assert files == {"2014-05-02", "2014-05-03"}


def test_data_of_which_nothing_is_chosen_raises(spark, scratch):
    write_day(spark, scratch, "2014-05-01", ["a"], complete=False)
    for options in ({}, {"pattern": "*"}, {"require_success": False, "date_from": "2015-01-01"}):
        with pytest.raises(FileNotFoundError):
            read_text_dirs(spark, scratch, **options)
    with pytest.raises(FileNotFoundError):
        read_text_dirs(spark, f"{scratch}/nowhere")


def make_folder(spark, path):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def test_an_empty_root_reads_as_empty(spark, scratch):
    make_folder(spark, scratch)
    df = read_text_dirs(spark, scratch, with_date=True)
    assert df.count() == 0 and df.columns == ["value", "date"]


@pytest.mark.parametrize("day", ["", "2014-05-01", "2014/05/01", "day=2014-05-01", "a/b/c"])
def test_every_layout_reads_under_the_default_call(spark, scratch, day):
    write_day(spark, scratch, day, ["a", "b"])
    df = read_text_dirs(spark, scratch)
    assert df.columns == ["value"] and sorted(r.value for r in df.collect()) == ["a", "b"]


def test_a_marker_on_the_root_covers_what_is_below(spark, scratch):
    write_day(spark, scratch, "2014/05/01", ["a"], complete=False)
    write_day(spark, scratch, "2014/05/02", ["b"], complete=False)
    make_folder(spark, f"{scratch}/_SUCCESS")
    assert read_text_dirs(spark, scratch).count() == 2
    assert read_text_dirs(spark, scratch, date_from="2014-05-02").count() == 1


def test_days_outside_the_range_are_not_listed(spark, scratch):
    root = f"{scratch}/days"
    df = spark.range(60).selectExpr("date_add(date'2024-01-01', cast(id as int)) as day", "cast(id as string) as value")
    df.write.partitionBy("day").text(root)
    from tessera.sources import read_partitioned_text
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    one = read_partitioned_text(spark, root, "day", date_from="2024-02-10", date_to="2024-02-10")
    assert len(tracker.getJobIdsForGroup(None)) == before  # no listing job
    assert [(str(r.day), r.value) for r in one.collect()] == [("2024-02-10", "40")]


def test_explicit_folder_list(spark, scratch):
    a = write_day(spark, scratch, "2014-05-01", ["a"])
    b = write_day(spark, scratch, "2014-05-02", ["b", "c"], complete=False)
    assert read_text_dirs(spark, [a, b]).count() == 1
    assert read_text_dirs(spark, [a, b], require_success=False).count() == 3


def test_nested_date_layout(spark, scratch):
    for day, n in (("2014/04/30", 2), ("2014/05/01", 1), ("2014/05/02", 3)):
        write_day(spark, scratch, day, [f"x{i}" for i in range(n)])
    write_day(spark, scratch, "2014/05/03", ["late"], complete=False)
    df = read_text_dirs(spark, scratch, pattern="*/*/*", date_from="2014-05-01", with_date=True)
    got = sorted((str(r.date), r.value) for r in df.collect())
    assert [d for d, _ in got] == ["2014-05-01"] + ["2014-05-02"] * 3
    assert read_text_dirs(spark, scratch, pattern="*/*/*").count() == 6


def test_partitioned_text_prunes_days_and_needs_success(spark, scratch):
    from pyspark.sql import functions as F

    from tessera.sources import read_partitioned_text
    rows_ = [("2014-05-01", "a"), ("2014-05-02", "b"), ("2014-05-02", "c"), ("2014-05-03", "d")]
    df = spark.createDataFrame(rows_, "day string, value string").withColumn("day", F.to_date("day"))
    root = f"{scratch}/t"
    df.write.partitionBy("day").text(root)
    got = read_partitioned_text(spark, root, "day", date_from="2014-05-02", date_to="2014-05-02")
    assert sorted(r.value for r in got.collect()) == ["b", "c"]
    assert all("day=2014-05-02" in f for f in got.inputFiles())
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{root}/_SUCCESS")
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, False)
    assert read_partitioned_text(spark, root, "day").count() == 0


def test_wide_and_deep_trees_are_listed_whole(spark, tmp_path):
    """More folders in a level than calls at a time; markers above, hidden folders, folders out of range."""
    from tessera.sources.text_dirs import LISTINGS, text_folders
    want = set()
    for i in range(LISTINGS + 9):
        for j, month in enumerate(("2014/05", "2014/06")):
            leaf = tmp_path / f"t{i}" / month / f"{1 + i % 28:02}"
            leaf.mkdir(parents=True)
            (leaf / "part-0").write_text("x\n")
            if i % 3 == 0:
                (tmp_path / f"t{i}" / "_SUCCESS").touch()
            elif i % 3 == 1:
                (leaf / "_SUCCESS").touch()
            if j == 0 and i % 3 != 2:
                want.add(str(leaf))
    hidden = tmp_path / "_temporary" / "2014" / "05" / "01"
    hidden.mkdir(parents=True)
    (hidden / "part-0").write_text("x\n")
    found, anything = text_folders(spark, str(tmp_path), date_to="2014-05-31")
    assert anything and {f.removeprefix("file:") for f in found} == want and found == sorted(found)
    every, _ = text_folders(spark, str(tmp_path), require_success=False)
    assert len(every) == 2 * (LISTINGS + 9)
