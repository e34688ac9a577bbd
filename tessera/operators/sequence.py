"""Cutting ordered per-key sequences into chunks of bounded size."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import scratch


CHUNK_ROWS = 500_000  # of a chunk, about
LEAST_ROWS = 2_000  # fewer are not worth a chunk of their own


def cut_by_range(df: DataFrame, order: Sequence[str], chunk: str, rows_per_chunk: int, rows: int) -> DataFrame:
    """``df`` dealt to one partition per chunk of ``order``, numbered by ``chunk``.

    The borders are drawn anew by every job that reads the frame: write what
    is made of it, and read that.
    """
    busy = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / LEAST_ROWS))
    chunks = max(math.ceil(rows / rows_per_chunk), busy, 1)
    return df.repartitionByRange(chunks, *[F.col(c).asc_nulls_first() for c in order]).withColumn(
        chunk, F.spark_partition_id().cast("bigint"))


def begins(table: pa.Table, columns: Sequence[str]) -> np.ndarray:
    """Whether each row differs in ``columns`` from the row before it (the first does); nulls are equal, so are NaN."""
    out = np.ones(table.num_rows, bool)
    if not table.num_rows:
        return out
    out[1:] = False
    for c in columns:
        col = table.column(c).combine_chunks()
        if pa.types.is_nested(col.type):
            values = col.to_pylist()
            out[1:] |= [a != b for a, b in zip(values[1:], values[:-1])]
            continue
        a, b = col[1:], col[:-1]
        differ = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
        if pa.types.is_floating(col.type):
            nan = pc.fill_null(pc.is_nan(col), False).to_numpy(zero_copy_only=False)
            differ = differ & ~(nan[1:] & nan[:-1])
        null = col.is_null().to_numpy(zero_copy_only=False)
        out[1:] |= differ | (null[1:] != null[:-1])
    return out


def in_chunks(df: DataFrame, order: Sequence[str], chunk: str = "__b", rows_per_chunk: int = CHUNK_ROWS,
              rows: int | None = None) -> DataFrame:
    """``df`` with a chunk number: rows in ascending ``order`` (nulls first), cut by row counts.

    Spark's range partitioning samples the rows and deals them out evenly, so
    a key with a third of all rows gets as many chunks as its rows need,
    also when they all fall within an hour, or at one instant or without a
    time (the further columns of ``order`` cut those). The number of chunks
    follows the rows, counted first (or ``rows``, where the caller knows
    about how many there are): about ``rows_per_chunk`` in each, and for
    small inputs as many chunks as there are shuffle partitions to work on
    them. Only rows that agree in all of ``order`` must share a chunk.
    The numbered rows are written to the shared folder once, so that every
    reader sees the same chunks.
    """
    spark = df.sparkSession
    path = scratch(spark)
    numbered = cut_by_range(df, order, chunk, rows_per_chunk, df.count() if rows is None else rows)
    numbered.write.parquet(path)
    return spark.read.schema(numbered.schema).parquet(path)
