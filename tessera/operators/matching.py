"""Matching jobs: pair digest match, time-limited exclusion, option expansion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import PAIR_SEPARATOR, pair_digest
from tessera.operators.sequence import in_chunks


def pair_digest_match(pairs: DataFrame, digests: DataFrame, a: str, b: str,
                      digest_col: str = "digest", sep: str = PAIR_SEPARATOR) -> DataFrame:
    """Candidate pairs whose MD5 of ``a<sep>b`` appears in a digest table.

    Output ``(a, b, digest)``, one row per matching candidate row. The digest
    is computed once per candidate and matched by an equi-join on the digest
    (hash or sort-merge, chosen at runtime from measured sizes) instead of
    comparing every candidate with every digest. Digests are reduced to
    distinct values first, so a repeated digest cannot multiply rows and the
    join is a semi join. MD5 values are uniform, so the join key has no hot
    value unless the same pair repeats; AQE splits such a partition.

    Candidates are rows of a table: no all-pairs product of two inputs is
    formed here. A null side gives no candidate.
    """
    wanted = digests.select(F.col(digest_col).alias("digest")).where(F.col("digest").isNotNull()).distinct()
    cand = (pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull())
            .select(a, b, pair_digest(a, b, sep).alias("digest")))
    return cand.join(wanted, "digest", "left_semi").select(a, b, "digest")


def _epoch_micros(ts: Column, dtype: str) -> Column:
    """Microseconds since 1970-01-01 on the column's own clock.

    A zoned ``timestamp`` is an instant: its exact epoch microseconds, so
    durations are real elapsed time, also across a daylight-saving change.
    A ``timestamp_ntz`` is a wall-clock reading: its difference from the
    wall-clock epoch is a day-time interval that never passes through a
    time zone, read back as exact seconds with microseconds. A ``bigint`` is
    taken to be such microseconds already.
    """
    if dtype == "bigint":
        return ts
    if dtype != "timestamp_ntz":
        return F.unix_micros(ts.cast("timestamp"))
    since = ts - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (since.cast("interval second").cast("decimal(24,6)") * F.lit(1_000_000)).cast("bigint")


def check_free(df: DataFrame, names: Sequence[str]) -> None:
    """Fail loudly instead of overwriting an input column with a helper column."""
    clash = sorted(set(df.columns) & set(names))
    if clash:
        raise ValueError(f"input has columns reserved for internal use: {clash}")


def ttl_exclude(candidates: DataFrame, exclusions: DataFrame, key: str, ts: str,
                ttl_hours: float = 3.0, excl_key: str | None = None,
                excl_ts: str | None = None) -> DataFrame:
    """Candidate rows not covered by an exclusion of the same key.

    A candidate at time t is dropped when an exclusion of its key exists at
    time e with ``e <= t < e + ttl`` (an exclusion lives ``ttl`` hours).
    Output: the candidate rows unchanged (all their columns).

    Only the latest exclusion at or before t matters, so no candidate is
    ever paired with all exclusions of its key. Candidates and exclusions
    (each instant once per key) are put in one sequence by (key, time) and
    cut into chunks by row counts (see ``in_chunks``; a hash of the
    candidate cuts rows of one instant). A running maximum gives the latest
    exclusion so far in the chunk; one row per key and chunk carries it into
    the next ones. Null keys or times never exclude and are not excluded;
    such candidates take no part in the sequence.
    """
    excl_key = excl_key or key
    excl_ts = excl_ts or ts
    dtype = candidates.schema[ts].dataType.simpleString()
    ttl_us = int(round(ttl_hours * 3600 * 1_000_000))
    if ttl_us <= 0:
        raise ValueError("ttl_hours must be positive")
    cand_cols = candidates.columns
    check_free(candidates, ["__k", "__us", "__c", "__tie", "__b", "__last", "__prev", "__pk", "__pb"])

    placed = candidates.withColumns({"__k": F.col(key), "__us": _epoch_micros(F.col(ts), dtype)})
    hashed = [c for c, kind in candidates.dtypes if "map<" not in kind and "variant" not in kind]
    alone = F.col("__k").isNull() | F.col("__us").isNull()
    cand = placed.where(~alone).withColumns({"__c": F.lit(1), "__tie": F.xxhash64(*hashed)})
    exc = (exclusions
           .select(F.col(excl_key).alias("__k"), _epoch_micros(F.col(excl_ts).cast(dtype), dtype).alias("__us"))
           .where(F.col("__k").isNotNull() & F.col("__us").isNotNull()).distinct()
           .withColumns({"__c": F.lit(0), "__tie": F.lit(0).cast("bigint")}))
    order = ["__us", "__c", "__tie"]  # at one instant exclusions come first
    both = in_chunks(cand.unionByName(exc, allowMissingColumns=True), ["__k", *order],
                     rows=candidates.count() + exclusions.count())
    w = (Window.partitionBy("__k", "__b").orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    excluded_at = F.when(F.col("__c") == 0, F.col("__us"))
    swept = both.withColumn("__last", F.max(excluded_at).over(w)).where(F.col("__c") == 1)
    # the latest exclusion of all earlier chunks of the key: one row per key and chunk
    per_chunk = both.groupBy("__k", "__b").agg(F.max(excluded_at).alias("__m"))
    earlier = Window.partitionBy("__k").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    prev = per_chunk.select(F.col("__k").alias("__pk"), F.col("__b").alias("__pb"),
                            F.max("__m").over(earlier).alias("__prev")).where(F.col("__prev").isNotNull())
    joined = swept.join(prev, (F.col("__k") == F.col("__pk")) & (F.col("__b") == F.col("__pb")), "left")
    latest = F.coalesce("__last", "__prev")
    covered = F.coalesce(F.col("__us") < latest + ttl_us, F.lit(False))
    return joined.where(~covered).select(*cand_cols).unionByName(placed.where(alone).select(*cand_cols))


def active_at(exclusions: DataFrame, ts: str, as_of: Column, ttl_hours: float = 3.0) -> DataFrame:
    """Exclusions alive at instant ``as_of``: ``ts <= as_of < ts + ttl``."""
    ttl_us = int(round(ttl_hours * 3600 * 1_000_000))
    dtype = exclusions.schema[ts].dataType.simpleString()
    t = _epoch_micros(F.col(ts), dtype)
    now = _epoch_micros(as_of.cast(dtype), dtype)
    return exclusions.where((t <= now) & (now < t + F.lit(ttl_us)))


def option_expand(regions: DataFrame, region_col: str, suffixes: str | Sequence[str],
                  sep: str = "", keep: Sequence[str] = ()) -> DataFrame:
    """One row per (region, zone), zone = region + sep + suffix.

    ``suffixes`` is either an array column of ``regions`` (per-row suffix
    lists) or a list of suffixes applied to every row. Either way each row is
    expanded in place with ``explode``: no join, no shuffle. A null region
    or suffix gives no zone.
    """
    clash = sorted({"region", "zone", "__s"} & set(keep))
    if clash:
        raise ValueError(f"kept columns clash with the output columns: {clash}")
    if isinstance(suffixes, str):
        arr = F.col(suffixes)
    else:
        arr = F.array(*[F.lit(s) for s in suffixes])
    exploded = regions.select(*keep, F.col(region_col).alias("region"), F.explode(arr).alias("__s"))
    return (exploded.where(F.col("region").isNotNull() & F.col("__s").isNotNull())
            .select(*keep, "region", F.concat("region", F.lit(sep), "__s").alias("zone")))
