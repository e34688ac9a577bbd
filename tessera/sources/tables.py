"""Parquet tables and derived line tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import FIELD_SEPARATOR, field, lines_of, split_fields


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder, with the schema that it has now; unused columns are pruned."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def document_lines(docs: DataFrame, text_col: str = "text",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per line of each document (``value``), like a text-file read."""
    return docs.select(*keep, F.explode(lines_of(text_col)).alias("value"))


def lines_frame(spark: SparkSession, lines: list[str]) -> DataFrame:
    """A small in-memory list of lines as a ``value`` table (fixtures)."""
    return spark.createDataFrame([(line,) for line in lines], "value string")


def fields_table(lines: DataFrame, names: list[str], text_col: str = "value",
                 sep: str = FIELD_SEPARATOR, strict: bool = True) -> DataFrame:
    """Named columns from the separated fields of each line.

    ``names[i]`` is field ``i``; a name of ``None`` skips that field. With
    ``strict`` a line with too few fields raises (like positional access on
    the JVM); otherwise its missing fields are null. Extra fields are
    ignored. The split is computed once per line.
    """
    parts = lines.select(split_fields(text_col, sep).alias("_p"))
    return parts.select(*[field("_p", i, strict).alias(n) for i, n in enumerate(names) if n])
