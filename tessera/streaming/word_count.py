"""Word count as a Structured Streaming query over a folder of files.

New files in the source folder are read as they arrive (text lines, or a
text column of Parquet/JSON/... files), tokenised with the same expressions
as the batch job, and counted into streaming state. State and
progress live in a checkpoint folder on shared storage, so a restarted
query (or a lost executor) resumes where it stopped. Each micro-batch
writes the changed counts (update mode) or the whole table (complete mode)
into a Parquet folder of its own.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tessera.functions.text import WORD_PATTERN
from tessera.operators.text import word_count
from tessera.sources.text_dirs import completed_dirs

COMPACT_EVERY = 10  # batches
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def word_count_stream_df(spark: SparkSession, source_dir: str, fmt: str = "text",
                         text_col: str = "value", schema: StructType | str | None = None,
                         options: dict[str, str] | None = None,
                         max_files_per_trigger: int | None = None,
                         spread: int | None = None,
                         pattern: str = WORD_PATTERN) -> DataFrame:
    """The streaming ``(word, cnt)`` DataFrame (not started).

    ``fmt``/``schema``/``options`` describe the file source (a file stream
    needs a schema unless it is text). ``spread`` round-robins each batch
    over that many tasks before tokenising, if the caller wants it.
    """
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(source_dir).select(text_col)
    if spread:
        lines = lines.repartition(spread)
    return word_count(lines, text_col, pattern)


def start_word_count_stream(spark: SparkSession, source_dir: str, sink_dir: str,
                            checkpoint_dir: str, output_mode: str = "update",
                            available_now: bool | None = None, processing_time: str | None = None,
                            compact_every: int = COMPACT_EVERY,
                            after_batch: Callable[[DataFrame, int], None] | None = None, **source) -> StreamingQuery:
    """Start the query, writing each micro-batch to ``sink_dir`` through ``foreachBatch``.

    ``update`` (default): batch n writes the words whose count changed into
    the folder ``batch-n``, and every ``compact_every`` batches the counts so
    far are merged into one ``snapshot-n`` and the folders that it covers are
    deleted; so reads open a bounded number of folders, however long the
    stream runs. ``complete``: batch n writes the whole table as
    ``snapshot-n``. A folder counts once its ``_SUCCESS`` marker is there,
    and the snapshot before the latest is kept for readers that began with
    it, so a reader never sees half a write; a replayed batch overwrites its
    own folder with the same values. State (one row per distinct word) is
    kept in RocksDB, off the heap. ``processing_time`` (e.g. ``"1 minute"``)
    keeps the query polling; otherwise it processes the files present now
    and stops. ``after_batch`` is called with the changed counts that an
    update-mode batch has written and its number, again if it is replayed.
    ``source`` takes the keyword arguments of ``word_count_stream_df``.
    """
    if output_mode not in ("update", "complete"):
        raise ValueError("output_mode must be 'update' or 'complete'")
    if processing_time and available_now:
        raise ValueError("choose either processing_time or available_now")
    counts = word_count_stream_df(spark, source_dir, **source)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if output_mode == "complete":
            batch.write.mode("overwrite").parquet(f"{sink_dir}/snapshot-{batch_id}")
            _drop_covered(session, sink_dir)
            return
        path = f"{sink_dir}/batch-{batch_id}"
        batch.write.mode("overwrite").parquet(path)
        if after_batch:
            after_batch(session.read.schema(batch.schema).parquet(path), batch_id)
        if (batch_id + 1) % compact_every == 0:
            merged = read_word_counts(session, sink_dir, upto=batch_id)
            merged.write.mode("overwrite").parquet(f"{sink_dir}/snapshot-{batch_id}")
            _drop_covered(session, sink_dir)

    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, ROCKSDB)
    try:
        writer = (counts.writeStream.outputMode(output_mode)
                  .option("checkpointLocation", checkpoint_dir)
                  .foreachBatch(write_batch))
        if processing_time:  # keeps polling the folder
            writer = writer.trigger(processingTime=processing_time)
        elif available_now is None or available_now:  # the files present now, then stop
            writer = writer.trigger(availableNow=True)
        return writer.start()
    finally:
        spark.conf.set(provider, before)


def _parts(spark: SparkSession, sink_dir: str) -> dict[str, list[int]]:
    """Numbers of the finished snapshots and batches in a sink folder, ascending."""
    out: dict[str, list[int]] = {"snapshot": [], "batch": []}
    for folder in completed_dirs(spark, sink_dir):
        kind, _, n = folder.rsplit("/", 1)[-1].rpartition("-")
        if kind in out and n.isdigit():
            out[kind].append(int(n))
    return {k: sorted(v) for k, v in out.items()}


def _drop_covered(spark: SparkSession, sink_dir: str) -> None:
    """Delete batches that the snapshot before the latest covers, and snapshots older than that."""
    parts = _parts(spark, sink_dir)
    if len(parts["snapshot"]) < 2:
        return
    previous = parts["snapshot"][-2]
    old = [f"batch-{n}" for n in parts["batch"] if n <= previous]
    old += [f"snapshot-{n}" for n in parts["snapshot"] if n < previous]
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in old:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sink_dir}/{name}")
        p.getFileSystem(conf).delete(p, True)


def read_word_counts(spark: SparkSession, sink_dir: str, output_mode: str = "update",
                     upto: int | None = None) -> DataFrame:
    """The current ``(word, cnt)`` table from a sink folder (of batches up to ``upto``).

    The latest finished snapshot, and of each word the row of the highest
    later batch.
    """
    parts = _parts(spark, sink_dir)
    wanted = [n for n in parts["snapshot"] if upto is None or n < upto]
    last = wanted[-1] if wanted else -1
    frames = [spark.read.parquet(f"{sink_dir}/snapshot-{last}").withColumn("batch_id", F.lit(last))] if wanted else []
    if output_mode == "update":
        frames += [spark.read.parquet(f"{sink_dir}/batch-{n}").withColumn("batch_id", F.lit(n))
                   for n in parts["batch"] if n > last and (upto is None or n <= upto)]
    if not frames:  # no batch has run yet: nothing counted
        return spark.createDataFrame([], "word string, cnt bigint")
    if len(frames) == 1:
        return frames[0].select("word", "cnt")
    every = functools.reduce(DataFrame.unionByName, frames)
    return every.groupBy("word").agg(F.max_by("cnt", "batch_id").alias("cnt"))


def run_word_count_stream(spark: SparkSession, source_dir: str, sink_dir: str,
                          checkpoint_dir: str, output_mode: str = "update",
                          timeout_sec: float | None = None, **source) -> DataFrame:
    """Process every file present now, then return the count table.

    With ``timeout_sec``, a query still running at the deadline is stopped
    and ``TimeoutError`` is raised (its checkpoint lets a later run resume),
    rather than returning the counts of the batches finished so far.
    """
    q = start_word_count_stream(spark, source_dir, sink_dir, checkpoint_dir, output_mode,
                                True, **source)
    if timeout_sec is not None:
        finished = q.awaitTermination(timeout_sec) if timeout_sec > 0 else not q.isActive
        if not finished:
            q.stop()
            raise TimeoutError(f"word count stream still running after {timeout_sec} s")
    else:
        q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"word count stream failed: {q.exception()}")
    return read_word_counts(spark, sink_dir, output_mode)
