"""Folders read run by run, counts kept as a top-k, sets kept by day: each equal to the whole job."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import daily_sets, dense_ids, distinct_over_ranges, word_count, word_count_topk
from tessera.sources import data_folders, lines_frame, read_incremental, run_incremental, taken_folders
from tessera.streaming import read_topk, run_word_topk_stream, update_topk

COUNT = "date date, n bigint"


def write(spark, folder, lines, finished=True):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", str(finished).lower()).text(folder)


def per_day(lines):
    return lines.groupBy("date").agg(F.count(F.lit(1)).alias("n"))


def test_each_folder_is_counted_once_also_after_a_failed_run(spark, scratch):
    tree, out = f"{scratch}/tree", f"{scratch}/out"
    write(spark, f"{tree}/2024/05/01", ["a", "b"])
    write(spark, f"{tree}/2024/05/02", ["c"], finished=False)
    assert run_incremental(spark, tree, out, per_day, with_date=True) == 1
    assert run_incremental(spark, tree, out, per_day, with_date=True) == 0
    write(spark, f"{tree}/2024/05/02", ["c", "d", "e"])
    write(spark, f"{tree}/deep/day=2024-05-03/x", ["f"])

    def fails(lines):
        return per_day(lines).withColumn("n", F.raise_error(F.lit("broken")).cast("bigint"))

    with pytest.raises(Exception, match="broken"):
        run_incremental(spark, tree, out, fails, with_date=True)
    assert rows(read_incremental(spark, out, COUNT)) == [(dt.date(2024, 5, 1), 2)]
    assert run_incremental(spark, tree, out, per_day, with_date=True, most=1) == 1
    assert run_incremental(spark, tree, out, per_day, with_date=True) == 1
    assert rows(read_incremental(spark, out, COUNT)) == [
        (dt.date(2024, 5, 1), 2), (dt.date(2024, 5, 2), 3), (dt.date(2024, 5, 3), 1)]
    assert sorted(r.run for r in taken_folders(spark, out).collect()) == [0, 1, 2]


def test_marker_above_and_days_wanted(spark, scratch):
    tree = f"{scratch}/tree"
    spark.createDataFrame([("2024-01-0%d" % i, "x") for i in range(1, 6)], "day string, value string").write.partitionBy(
        "day").text(f"{tree}/a")
    assert data_folders(spark, tree).count() == 5
    assert run_incremental(spark, tree, f"{scratch}/o2", per_day, with_date=True, date_from="2024-01-04") == 2
    with pytest.raises(FileNotFoundError):
        run_incremental(spark, f"{scratch}/nowhere", f"{scratch}/o3", per_day)


def test_many_folders_are_listed_by_tasks(spark, scratch):
    spark.range(120).selectExpr("id as part", "cast(id as string) as value").write.partitionBy("part").text(f"{scratch}/many")
    assert data_folders(spark, f"{scratch}/many").count() == 120
    assert run_incremental(spark, f"{scratch}/many", f"{scratch}/out", word_count) == 120
    assert read_incremental(spark, f"{scratch}/out", "word string, cnt bigint").count() == 0  # digits are no words


@pytest.mark.parametrize("seed", [1, 2])
def test_topk_after_every_batch(spark, scratch, seed):
    rng, counts, refills = random.Random(seed), {}, 0
    for batch in range(7):
        changes = {}
        for w in rng.sample(range(60), 25 if batch else 60):
            c = counts.get(w) or 0
            changes[w] = c + rng.randrange(1, 9) if rng.random() < 0.5 else rng.choice([0, None, max(c - rng.randrange(30), 0)])
        after = {**counts, **changes}
        frame = spark.createDataFrame([(f"w{w}", c) for w, c in changes.items()], "word string, cnt long")

        def full():
            return spark.createDataFrame([(f"w{w}", c) for w, c in after.items()], "word string, cnt long")

        for _ in range(2 if batch % 3 == 1 else 1):  # now and then a batch is replayed
            refills += update_topk(frame, f"{scratch}/top", batch, 8, full, spare=1 + seed % 2)
        counts = after
        want = sorted(((c, f"w{w}") for w, c in counts.items() if c), reverse=True)[:8]
        got = read_topk(spark, f"{scratch}/top", 8).orderBy("rnk").collect()
        assert [(r.cnt, r.word) for r in got] == want and [r.rnk for r in got] == list(range(1, len(want) + 1))
    assert refills < 7 and (refills or seed % 2)


def test_counts_that_only_grow_need_no_second_look(spark, scratch):
    lines = [f"w{i % 13} w{i % 7} w{i % 29}" for i in range(60)]
    lines_frame(spark, lines).repartition(5).write.text(f"{scratch}/src")
    got = run_word_topk_stream(spark, f"{scratch}/src", f"{scratch}/live", k=5, max_files_per_trigger=1)
    assert rows(got) == rows(word_count_topk(lines_frame(spark, lines), 5))
    assert read_topk(spark, f"{scratch}/none", 5).collect() == []


def test_distinct_over_any_range(spark):
    rng = random.Random(4)
    day = dt.date(2024, 1, 1)
    data = [(day + dt.timedelta(days=rng.randrange(40)) if i % 50 else None, "hot" if i % 3 == 0 else rng.choice([None, f"a{rng.randrange(300)}"]),
             rng.random() < 0.3) for i in range(3000)]
    df = spark.createDataFrame(data, "day date, addr string, hit boolean")
    first = dense_ids(df.where("day < date'2024-01-20'"), "addr")
    ids = dense_ids(df, "addr", known=first)
    assert sorted(r.id for r in ids.collect()) == list(range(1, ids.count() + 1))
    assert first.join(ids, ["addr", "id"]).count() == first.count()
    sets = daily_sets(df.join(ids, "addr"), "day", "id", {"hit": F.col("hit"), "all": F.lit(True)})
    ranges = [(day, day), (day, day + dt.timedelta(days=39)), (day + dt.timedelta(days=9), day + dt.timedelta(days=17)),
              (day - dt.timedelta(days=9), day - dt.timedelta(days=1))]
    got = {(r.date_from, r.date_to): (r.n_hit, r.n_all) for r in distinct_over_ranges(sets, "day", ranges, ["hit", "all"]).collect()}
    for a, b in ranges:
        inside = [(x, h) for d, x, h in data if d and x and a <= d <= b]
        assert got[(a, b)] == (len({x for x, h in inside if h}), len({x for x, _ in inside}))
    assert len(got) == len(ranges) and distinct_over_ranges(sets, "day", [], ["hit"]).collect() == []


def test_ids_beyond_one_bitmap(spark):
    df = spark.range(1, 100_001).selectExpr("date'2024-01-01' as day", "id")
    sets = daily_sets(df, "day", "id", {"all": F.lit(True)})
    assert sets.count() == 4
    (r,) = distinct_over_ranges(sets, "day", [(dt.date(2024, 1, 1),) * 2], ["all"]).collect()
    assert r.n_all == 100_000
