"""The k largest counts of a growing count table, maintained from changed counts alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.sources.text_dirs import completed_dirs
from tessera.streaming.word_count import read_word_counts, run_word_count_stream

SPARE = 2  # so many times k rows are held, so that rows that fall out can be replaced


def _latest(spark: SparkSession, state_dir: str, before: int | None = None) -> int | None:
    numbers = [int(n) for f in completed_dirs(spark, state_dir, "top-*") if (n := f.rsplit("-", 1)[-1]).isdigit()]
    return max((n for n in numbers if before is None or n < before), default=None)


def update_topk(changes: DataFrame, state_dir: str, batch_id: int, k: int, full: Callable[[], DataFrame],
                key: str = "word", cnt: str = "cnt", spare: int = SPARE) -> bool:
    """Bring the k rows of largest count (ties: larger key) up to date with a batch of changed counts.

    ``changes`` has one row (``key``, ``cnt``) for each key whose count has
    changed, up or down; a null or non-positive count takes the key out. The
    folder ``top-<batch_id>`` gets the ``spare * k`` largest rows and the
    *bound*: the largest row ever left out since all counts were last looked
    at. A key that is not held and has not changed since cannot lie above
    the bound, so as long as k held rows do, they are the k largest, and the
    batch's work follows its changes, whatever the number of keys. When rows
    fall out (counts that go down) and fewer than k remain above the bound,
    ``full()`` (all counts after this batch) is looked at once.

    A batch that is replayed starts from the batch before it again and
    writes the same rows. Returns whether ``full`` was needed.
    """
    spark, held = changes.sparkSession, spare * k
    last = _latest(spark, state_dir, batch_id)
    order = [F.desc(cnt), F.desc(key)]
    changed = changes.select(key, F.col(cnt).cast("bigint").alias(cnt))
    bound, kept = None, changed
    if last is not None:
        before = spark.read.parquet(f"{state_dir}/top-{last}")
        bound = before.where("bound").select(cnt, key).first()
        kept = before.where("not bound").select(key, cnt).join(changed.select(key), key, "left_anti").unionByName(changed)
    best = kept.where(F.col(cnt) > 0).orderBy(*order).limit(held + 1).collect()  # a parameter bounds them
    refill = False
    if len(best) > held:
        out = best.pop()
        bound = max([b for b in (bound, (out[cnt], out[key])) if b is not None], key=tuple)
    sure = len(best) if bound is None else sum((r[cnt], r[key]) > tuple(bound) for r in best)
    if bound is not None and sure < k:
        refill = True
        best = full().select(key, F.col(cnt).cast("bigint").alias(cnt)).where(F.col(cnt) > 0).orderBy(*order).limit(held + 1).collect()
        out = best.pop() if len(best) > held else None
        bound = (out[cnt], out[key]) if out else None
    rows = [(r[key], r[cnt], False) for r in best if bound is None or (r[cnt], r[key]) > tuple(bound)]
    rows += [(bound[1], bound[0], True)] if bound is not None else []
    schema = f"`{key}` {changed.schema[key].dataType.simpleString()}, `{cnt}` bigint, bound boolean"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{state_dir}/top-{batch_id}")
    return refill


def read_topk(spark: SparkSession, state_dir: str, k: int, key: str = "word", cnt: str = "cnt",
              schema: str = "word string, cnt bigint") -> DataFrame:
    """(rnk, key, cnt): the k largest counts as of the last finished batch."""
    last = _latest(spark, state_dir)
    if last is None:
        held = spark.createDataFrame([], schema)
    else:
        held = spark.read.parquet(f"{state_dir}/top-{last}").where("not bound")
    order = [F.desc(cnt), F.desc(key)]
    top = held.orderBy(*order).limit(k)
    return top.select(F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("rnk"), key, cnt)


def run_word_topk_stream(spark: SparkSession, source_dir: str, root: str, k: int = 1000, **source) -> DataFrame:
    """The streaming word count with its k most frequent words maintained batch by batch: (rnk, word, cnt).

    Every batch of the count stream hands its changed counts to
    :func:`update_topk`. Folders below ``root``: ``sink``, ``checkpoint``,
    ``top``. ``source`` takes the keyword arguments of ``word_count_stream_df``.
    """
    sink, top = f"{root}/sink", f"{root}/top"

    def follow(batch: DataFrame, batch_id: int) -> None:
        update_topk(batch, top, batch_id, k, lambda: read_word_counts(batch.sparkSession, sink, upto=batch_id))

    run_word_count_stream(spark, source_dir, sink, f"{root}/checkpoint", after_batch=follow, **source)
    return read_topk(spark, top, k)
