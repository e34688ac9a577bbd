"""Log-analysis shares: share per value, top-k keys with share, affected share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ratio(num, den):
    """``num / den`` as DOUBLE; NULL instead of an error when ``den`` is 0."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def value_share(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Share of all rows whose ``col`` equals each wanted value.

    One row per wanted value ``(col, share)``, in the order given, ``col`` in
    the column's own type; a value that this type cannot hold is null there
    and has share 0. One scan and one path for any number of values: rows
    are counted per wanted value, all others together, in partial aggregates
    (at most one row more than there are wanted values), and the denominator
    is the sum of these counts, null values included.
    """
    if not values:
        raise ValueError("value_share needs at least one value")
    dtype = df.schema[col].dataType
    wanted = [F.lit(v).try_cast(dtype) for v in values]
    counts = (df.groupBy(F.when(F.col(col).isin(wanted), F.col(col)).alias("k"))
              .agg(F.count(F.lit(1)).alias("c")))
    pairs = F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", "c")))
    one = counts.agg(F.map_from_entries(pairs).alias("m"), F.sum("c").alias("total"))
    rows = one.select("m", "total", F.posexplode(F.array(*wanted)).alias("i", "v"))
    found = F.when(F.col("v").isNotNull(), F.try_element_at("m", F.col("v")))
    return (rows.orderBy("i").select(F.col("v").alias(col),
                                     _ratio(F.coalesce(found, F.lit(0)), F.col("total")).alias("share")))


def key_counts(df: DataFrame, col: str) -> DataFrame:
    """``(col, cnt)``: rows per key (partial + final hash aggregate)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))


def topk_share(df: DataFrame, col: str, k: int = 5) -> DataFrame:
    """The k most frequent keys with their count and share of all rows.

    Ordered by count descending, then key ascending. The denominator counts
    every row of the input (rows of any key, null keys included); it is an
    uncorrelated scalar subquery, computed once and inlined as a value, so
    no join is needed and no group is ever moved to a single task.
    """
    total = df.select(F.count(F.lit(1))).scalar()
    top = key_counts(df, col).orderBy(F.desc("cnt"), F.asc(col)).limit(k)
    return top.select(col, "cnt", _ratio(F.col("cnt"), total).alias("share"))


def affected_share(status: DataFrame, address: DataFrame, status_id: str, status_col: str,
                   status_value, address_id: str, address_col: str) -> DataFrame:
    """Share of distinct addresses touched by a given status.

    An address is affected when some row of ``address`` carrying it has an
    id with at least one ``status`` row of ``status_value``. The denominator
    is the number of distinct non-null addresses over **all** address rows,
    also those without any status row.

    Plan: the status side is filtered at the scan and reduced to its
    distinct ids (partial aggregate), so a hot id contributes one row and the
    join cannot multiply rows; a left join flags each address row; one
    aggregate per address and one global aggregate give both distinct
    counts from a single pass over each table. Output: ``n_affected``,
    ``n_total``, ``share``.
    """
    hit_ids = (status.where(F.col(status_col) == F.lit(status_value))
               .select(F.col(status_id).alias("_id")).where(F.col("_id").isNotNull())
               .distinct().withColumn("_hit", F.lit(True)))
    addr = (address.select(F.col(address_id).alias("_id"), F.col(address_col).alias("_addr"))
            .where(F.col("_addr").isNotNull()))
    flagged = addr.join(hit_ids, "_id", "left")
    per_addr = flagged.groupBy("_addr").agg(F.bool_or(F.coalesce("_hit", F.lit(False))).alias("hit"))
    out = per_addr.agg(F.count_if("hit").alias("n_affected"), F.count(F.lit(1)).alias("n_total"))
    return out.select("n_affected", "n_total", _ratio(F.col("n_affected"), F.col("n_total")).alias("share"))


def format_share_lines(df: DataFrame, key: str, cnt: str = "cnt", share: str = "share") -> DataFrame:
    """Text form of key/count/share rows: ``<key> <count> <share>``."""
    return df.select(F.format_string("%s %d %s", F.col(key), F.col(cnt),
                                     F.col(share).cast("string")).alias("line"))
