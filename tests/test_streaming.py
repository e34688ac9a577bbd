"""The streaming word count equals the batch word count on the same lines."""

from conftest import rows
from tessera.operators import word_count
from tessera.sources import lines_frame
from tessera.streaming import run_word_count_stream

from test_text import VERSE, VERSE_COUNTS


def test_stream_equals_batch_over_several_batches(spark, scratch):
    src = f"{scratch}/src"
    lines_frame(spark, VERSE).repartition(4).write.text(src)
    out = run_word_count_stream(spark, src, f"{scratch}/sink", f"{scratch}/ckpt",
                                max_files_per_trigger=1)
    assert dict(out.collect()) == VERSE_COUNTS


def test_stream_resumes_from_checkpoint(spark, scratch):
    src, sink, ckpt = f"{scratch}/src", f"{scratch}/sink", f"{scratch}/ckpt"
    lines_frame(spark, VERSE[:3]).coalesce(1).write.text(f"{src}")
    first = run_word_count_stream(spark, src, sink, ckpt)
    assert rows(first) == rows(word_count(lines_frame(spark, VERSE[:3])))
    lines_frame(spark, VERSE[3:]).coalesce(1).write.mode("append").text(f"{src}")
    second = run_word_count_stream(spark, src, sink, ckpt)
    assert dict(second.collect()) == VERSE_COUNTS


def test_stream_over_parquet_table(spark, scratch):
    docs = spark.createDataFrame([(1, VERSE[1]), (2, VERSE[2]), (3, None)], "doc_id long, text string")
    docs.coalesce(1).write.parquet(f"{scratch}/tables/documents.parquet")
    spark.createDataFrame([(1,)], "x int").write.parquet(f"{scratch}/tables/other.parquet")
    out = run_word_count_stream(spark, f"{scratch}/tables/documents.parquet", f"{scratch}/sink",
                                f"{scratch}/ckpt", fmt="parquet", text_col="text",
                                schema=docs.schema, spread=4)
    assert rows(out) == rows(word_count(docs, "text"))


def test_complete_mode_equals_update_mode(spark, scratch):
    src = f"{scratch}/src"
    lines_frame(spark, VERSE).repartition(3).write.text(src)
    upd = run_word_count_stream(spark, src, f"{scratch}/u", f"{scratch}/uc", max_files_per_trigger=1)
    full = run_word_count_stream(spark, src, f"{scratch}/c", f"{scratch}/cc", output_mode="complete",
                                 max_files_per_trigger=1)
    assert rows(upd) == rows(full) == sorted(VERSE_COUNTS.items())


def test_stream_with_no_input_gives_empty_counts(spark, scratch):
    src = f"{scratch}/empty"
    lines_frame(spark, []).write.text(src)
    out = run_word_count_stream(spark, src, f"{scratch}/sink", f"{scratch}/ckpt")
    assert out.count() == 0 and out.columns == ["word", "cnt"]


def test_registered_stream_reads_a_folder_table(spark, scratch):
    from tessera.plans.catalog import q_word_count_stream
    data = f"{scratch}/data"
    docs = spark.createDataFrame([(1, "a b a"), (2, None)], "doc_id long, text string")
    docs.repartition(2).write.parquet(f"{data}/documents.parquet")
    assert sorted(tuple(r) for r in q_word_count_stream(spark, data).collect()) == [("a", 2), ("b", 1)]


def test_stream_timeout_stops_the_query(spark, scratch):
    import pytest
    src = f"{scratch}/src"
    lines_frame(spark, VERSE).repartition(3).write.text(src)
    with pytest.raises(TimeoutError):
        run_word_count_stream(spark, src, f"{scratch}/sink", f"{scratch}/ckpt",
                              timeout_sec=0.001, max_files_per_trigger=1)
    assert not spark.streams.active
    # the checkpoint lets a later run finish the work
    out = run_word_count_stream(spark, src, f"{scratch}/sink", f"{scratch}/ckpt", max_files_per_trigger=1)
    assert dict(out.collect()) == VERSE_COUNTS


def test_many_batches_leave_few_folders(spark, scratch):
    from tessera.streaming.word_count import _parts, read_word_counts
    src, sink = f"{scratch}/src", f"{scratch}/sink"
    lines = [f"w{i} common" for i in range(23)]
    lines_frame(spark, lines).repartition(23).write.text(src)
    n_files = spark.read.text(src).select("_metadata.file_path").distinct().count()
    out = run_word_count_stream(spark, src, sink, f"{scratch}/ckpt", max_files_per_trigger=1, compact_every=4)
    assert rows(out) == rows(word_count(lines_frame(spark, lines), "value"))
    parts = _parts(spark, sink)
    assert n_files > 8 and len(parts["snapshot"]) <= 2 and len(parts["batch"]) <= 8
    assert len(read_word_counts(spark, sink).inputFiles()) < n_files


def test_a_replayed_batch_changes_nothing(spark, scratch):
    from tessera.streaming.word_count import read_word_counts
    sink = f"{scratch}/sink"
    for n, pairs in ((0, [("a", 1)]), (1, [("a", 2), ("b", 1)]), (1, [("a", 2), ("b", 1)])):
        spark.createDataFrame(pairs, "word string, cnt long").write.mode("overwrite").parquet(f"{sink}/batch-{n}")
    assert rows(read_word_counts(spark, sink)) == [("a", 2), ("b", 1)]


def test_state_is_kept_in_rocksdb(spark, scratch):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    lines_frame(spark, ["a b"]).write.text(f"{scratch}/src")
    run_word_count_stream(spark, f"{scratch}/src", f"{scratch}/sink", f"{scratch}/ckpt")
    assert spark.conf.get(key) == before
    names = spark.sparkContext.wholeTextFiles(f"{scratch}/ckpt/offsets").values().collect()
    assert any("RocksDBStateStoreProvider" in x for x in names)
