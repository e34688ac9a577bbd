"""The consecutive-failure counter per key as a stream, its state kept across batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from tessera.operators.matching import check_free
from tessera.session import ship_package
from tessera.streaming.exclusions import event_instant

BUCKETS = 256  # over which keys are dealt; a bucket's keys share one state and one call

_STATE = "counters binary, waiting binary"
_NO_TIME = -(1 << 63)
_MICROS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def advance(failed: Sequence[bool | None], healthy: Sequence[bool], streak: int, cap: int | None
            ) -> tuple[list[int], int]:
    """The counter at each failure of an ordered sequence, and where it stands after it.

    Up by one at a failure, back to 0 at a success, unchanged where the
    outcome is unknown; with ``cap`` back to 0 after a healthy failure at
    which it is at the cap or beyond.
    """
    out = []
    for f, ok in zip(failed, healthy):
        if f is True:
            streak += 1
            out.append(streak)
            if cap and ok and streak >= cap:
                streak = 0
        elif f is False:
            streak = 0
    return out, streak


def _pack(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_all().to_pandas(integer_object_nulls=True)


def _key_text(df: DataFrame, key: str) -> Column:
    """One text for each key, null for the null key."""
    c, kind = F.col(key), dict(df.dtypes)[key]
    if kind in (*_WHOLE, "string", "date", "boolean") or kind.startswith("decimal"):
        return c.cast("string")
    if kind in ("float", "double"):
        c = c + F.lit(0.0)  # -0.0 and 0.0 are one key
    return F.when(c.isNotNull(), F.to_json(F.struct(c.alias("k")), _MICROS))


def _step(order: list[str], out: list[str], whole: list[str], cap: int | None):
    """All keys of a bucket at once: what the watermark has passed is counted, the rest waits."""
    sort = ["__code", "__us", *[x for c in order for x in ([f"__has_{c}", c] if c in whole else [c])]]

    def step(bucket: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        counted, waiting = state.get if state.exists else (None, None)
        counters = dict(_unpack(bytes(counted)).itertuples(index=False)) if counted else {}
        parts = [_unpack(bytes(waiting))] if waiting else []
        parts += [pdf.drop(columns=["__t", "__bucket"]) for pdf in batches if len(pdf)]
        mark = state.getCurrentWatermarkMs()  # rows up to it are complete
        later = None
        if parts:
            rows = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0]
            due = rows["__us"].to_numpy() <= mark * 1000
            ready, later = rows[due], rows[~due]
            if len(ready):
                ready = ready.assign(__code=pd.factorize(ready["__key"], use_na_sentinel=False)[0])
                ready = ready.sort_values(sort, kind="stable", na_position="first")
                yield _count(ready, counters, cap, out, whole)
        waits = later is not None and len(later) > 0
        if not counters and not waits:
            if state.exists:
                state.remove()  # nothing counted, nothing waiting
            return
        held = pd.DataFrame({"key": pd.Series(list(counters), dtype=object), "streak": list(counters.values())})
        state.update((_pack(held) if counters else None, _pack(later) if waits else None))
        if waits:
            first = -(-int(later["__us"].min()) // 1000)
            state.setTimeoutTimestamp(max(first, mark + 1))

    return step


def _count(ready: pd.DataFrame, counters: dict[str | None, int], cap: int | None, out: list[str],
           whole: list[str]) -> pd.DataFrame:
    """The failures of rows sorted by key and time, with their streaks; ``counters`` are moved on."""
    code, keys = ready["__code"].to_numpy(), ready["__key"].to_numpy()
    failed = [None if f < 0 else f > 0 for f in ready["__f"].tolist()]
    healthy, streaks = ready["__ok"].tolist(), []
    firsts = np.flatnonzero(np.diff(code, prepend=-1))
    for a, b in zip(firsts.tolist(), [*firsts[1:].tolist(), len(code)]):
        key = None if pd.isna(keys[a]) else keys[a]
        found, streak = advance(failed[a:b], healthy[a:b], counters.pop(key, 0), cap)
        streaks += found
        if streak:
            counters[key] = streak
    fails = ready[ready["__f"].to_numpy() > 0]
    shown = fails[out].assign(streak=streaks)
    for c in whole:
        if c in out and not (has := fails[f"__has_{c}"].to_numpy(bool)).all():
            shown[c] = pd.arrays.IntegerArray(fails[c].to_numpy().copy(), ~has)
    return shown


def failure_streak_stream_df(events: DataFrame, key: str, ts: str, failed: Column,
                             order_by: Sequence[str] = (), cap: int | None = 2, keep: Sequence[str] = (),
                             healthy: Column | None = None, delay: str = "10 minutes",
                             buckets: int = BUCKETS) -> DataFrame:
    """The streaming counter on each failing row (not started): ``keep``, ``key`` and ``streak``.

    As ``failure_streak``, row for row, with or without ``healthy``. Rows of
    a key are counted in ``(ts, *order_by)`` order: they wait in the key's
    state until the watermark (``delay`` behind the latest row) has passed
    them, so a batch may bring them in any order and split a streak
    anywhere; a timer wakes a bucket whose rows wait although no more come.
    Rows later than that are dropped by Spark (its progress counts them). A
    row without a time is counted when it comes, before its batch's others.
    Null keys are one key.

    Keys are dealt to ``buckets`` by hash, and a bucket is worked on as a
    whole: a call for each key would cost milliseconds, whatever it has to
    do. State: the waiting rows and the counters other than 0 of each
    bucket, in RocksDB; a bucket with neither has none. A task holds the
    rows that one bucket has in a batch and those that wait, which
    ``files_per_trigger`` of the source and ``delay`` bound, and its
    counters. A checkpoint goes on with the number of buckets it began with.
    """
    spark, order = events.sparkSession, list(order_by)
    columns = list(dict.fromkeys([*keep, key, *order]))
    kinds = dict(events.dtypes)
    whole = [c for c in columns if kinds[c] in _WHOLE]  # pandas has no nulls in these: they are told apart
    check_free(events.select(*columns), ["__us", "__t", "__f", "__ok", "__key", "__bucket", "streak",
                                         *[f"__has_{c}" for c in whole]])
    ok = F.lit(True) if healthy is None else F.coalesce(healthy, F.lit(False))
    at = event_instant(events, ts)
    rows = events.select(
        *[F.coalesce(F.col(c), F.lit(0).cast(kinds[c])).alias(c) if c in whole else F.col(c) for c in columns],
        *[F.col(c).isNotNull().alias(f"__has_{c}") for c in whole], _key_text(events, key).alias("__key"),
        F.when(failed, 1).when(~failed, 0).otherwise(-1).alias("__f"), ok.alias("__ok"),
        F.coalesce(F.unix_micros(at), F.lit(_NO_TIME)).alias("__us"), at.alias("__t")).withWatermark("__t", delay)
    rows = rows.withColumn("__bucket", F.pmod(F.xxhash64("__key"), F.lit(buckets)))
    out = list(dict.fromkeys([*keep, key]))
    result = StructType([events.schema[c] for c in out]).add("streak", "long")
    ship_package(spark)
    return rows.groupBy("__bucket").applyInPandasWithState(
        _step(order, out, whole, cap), result, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
