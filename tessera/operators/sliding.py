"""Sliding order statistics: the average of the n largest values of a trailing window, at every instant."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.time import ts_type
from tessera.operators.matching import _epoch_micros, check_free
from tessera.operators.sequence import begins, cut_by_range
from tessera.session import scratch, ship_package

CHUNK_ROWS = 100_000  # rows and window starts that one task takes at once, about
MARK, EVENT, POINT, WHOLE = 0, 1, 2, 3  # kinds of rows: a window's start, a value, an instant asked for, a chunk's list


def merge_tops(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Row by row the n largest of two lists (rows of numbers, ascending)."""
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    return both[:, max(both.shape[1] - n, 0):]


def range_tops(lists: np.ndarray, lo: np.ndarray, hi: np.ndarray, n: int) -> np.ndarray:
    """The n largest numbers of rows [lo, hi) of ``lists`` for each pair (ascending, -inf where there are fewer).

    Lists of 1, 2, 4, ... consecutive rows are merged from halves, and a
    range is put together from those that the bits of its length name; all
    ranges at once.
    """
    out = np.full((len(lo), n), -np.inf)
    at, left, level, width = lo.astype(np.int64).copy(), (hi - lo).astype(np.int64), lists, 1
    while len(left) and width <= int(left.max(initial=0)):
        mine = np.flatnonzero(left & width)
        if len(mine):
            out[mine] = merge_tops(out[mine], level[at[mine]], n)[:, -n:]
            at[mine] += width
        if len(level) > width:
            level = merge_tops(level[:-width], level[width:], n)
        width *= 2
    return out


def _values(tops: np.ndarray) -> list[list[float]]:
    """The numbers of each row, largest first."""
    return [row[::-1][: int(np.isfinite(row).sum())].tolist() for row in tops]


def _chunk_lists(key: str, names: list[str], span: int, n: int):
    """One chunk, rows in order: the average of each window that lies in it; of others, the lists to be merged.

    Those are each instant's list as far as the chunk goes and, only for keys
    that can go on in another chunk, the list from each window start on and
    the list of the whole.
    """

    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        rows = pa.Table.from_batches(batches)
        head = begins(rows, [key])
        seg = head.cumsum() - 1
        first = np.flatnonzero(head)
        stop = np.append(first[1:], len(seg))
        us, kind = rows.column("__us").to_numpy(), rows.column("__kind").to_numpy()
        v = rows.column("__v").to_numpy().astype(np.float64)  # NaN for null
        valued = np.isfinite(v) & (kind == EVENT)
        so_far = np.concatenate([[0], valued.cumsum()])
        v = v[valued]
        ask = np.flatnonzero(rows.column("__ask").to_numpy())
        start = (us[ask] - span) // 1_000_000 * 1_000_000
        lo = np.empty(len(ask), np.int64)
        own = np.searchsorted(ask, np.append(first, len(seg)))
        for s in np.flatnonzero(np.diff(own)):
            mine = slice(own[s], own[s + 1])
            lo[mine] = first[s] + np.searchsorted(us[first[s]:stop[s]], start[mine])
        begin = first[seg[ask]]
        closed = (lo > begin) | ((kind[lo] == MARK) & (us[lo] == start))
        marks = np.flatnonzero((kind == MARK) & (seg == seg[-1]))  # an earlier key's windows end in this chunk
        edge = np.unique([0, len(first) - 1])  # only these keys can go on in another chunk
        tops = range_tops(v[:, None], so_far[np.concatenate([np.where(closed, lo, begin), marks, first[edge]])],
                          so_far[np.concatenate([ask + 1, stop[seg[marks]], stop[edge]])], n)[:, ::-1]
        there = np.isfinite(tops)
        held = there.sum(axis=1)
        total = np.zeros(len(tops))
        with np.errstate(over="ignore"):
            for i in range(n):  # largest first, one after the other
                total = np.where(there[:, i], total + tops[:, i], total)
        done = np.concatenate([closed, np.zeros(len(marks) + len(edge), bool)])
        there[done] = False  # their average is all that is needed
        ends = np.concatenate([[0], there.sum(axis=1).cumsum()]).astype(np.int32)
        out = rows.select(names).take(pa.array(np.concatenate([ask, marks, first[edge]])))
        size = [len(ask), len(marks), len(edge)]
        more = {
            "__b": pa.array(np.full(len(tops), rows.column("__b")[0].as_py()), pa.int64()),
            "__kind": pa.array(np.repeat([EVENT, MARK, WHOLE], size), pa.int32()),
            "__start": pa.array(np.concatenate([start, us[marks], np.zeros(len(edge), np.int64)]), pa.int64()),
            "__closed": pa.array(np.concatenate([closed, np.ones(len(marks) + len(edge), bool)])),
            "__tops": pa.ListArray.from_arrays(pa.array(ends), pa.array(tops[there])),
            "avg_top": pa.array(total / np.maximum(held, 1), pa.float64(), mask=(held == 0) | ~done),
        }
        for name, column in more.items():
            out = out.append_column(name, column)
        yield from out.combine_chunks().to_batches()

    return run


def _between(key: str, n: int):
    """The merged lists of the chunks that lie wholly within windows."""

    def run(pairs: pd.DataFrame, chunks: pd.DataFrame) -> pd.DataFrame:
        if not len(pairs):
            return pairs.assign(__mid=pd.Series([], dtype=object))
        chunks = chunks.sort_values("__cb")
        b = chunks["__cb"].to_numpy(np.int64)
        lists = np.full((len(chunks), n), -np.inf)
        for i, tops in enumerate(chunks["__list"]):
            lists[i, n - len(tops):] = np.sort(np.asarray(tops, np.float64)) if len(tops) else []
        lo = np.searchsorted(b, pairs["__from"].to_numpy(np.int64), side="right")
        hi = np.searchsorted(b, pairs["__b"].to_numpy(np.int64))
        return pairs.assign(__mid=_values(range_tops(lists, lo, np.maximum(lo, hi), n)))

    return run


def trailing_topn_series(events: DataFrame, key: str, value: str, ts: str, hours: float = 12.0, n: int = 10,
                         order_by: Sequence[str] = (), keep: Sequence[str] = (), points: DataFrame | None = None,
                         digits: int | None = None) -> DataFrame:
    """``trailing_topn_avg`` as of every event: the average of the n largest values of its key so far.

    For an event at t: of the events of its key from ``t - hours`` (cut to
    seconds, inclusive) up to itself, in ``(ts, *order_by)`` order. With
    ``points`` (``key``, ``ts`` and ``keep`` columns), as of each of these
    rows instead, all events at its instant included. Output: ``keep``
    columns, ``key`` and ``avg_top`` (null without a value in the window).
    Values that are null, NaN or infinite count as none; null keys are one
    key; rows without a time have a null average and are in no window. ``ts``
    may also be BIGINT microseconds.

    One ordered sweep, no range join: events and the distinct starts of
    their windows (whole seconds) are put in one sequence by key and time
    and cut into chunks by row counts (see ``in_chunks``), so a hot key is
    spread over tasks. A chunk averages the windows that lie in it; for the
    others it gives lists of at most n values: from each start to its end,
    from its beginning to each event, and its own; a window that began in an
    earlier chunk is merged from those three kinds.
    """
    spark, order, keep = events.sparkSession, list(order_by), list(keep)
    asked = events if points is None else points
    names = list(dict.fromkeys([*keep, key]))
    check_free(asked.select(*names), ["__us", "__kind", "__v", "__ask", "__b", "__start", "__closed", "__tops", "__mid",
                                      "__from", "__end", "__mk", "__ms", "__pk", "__pf", "__pb", "avg_top"])
    span = int(round(hours * 3600 * 1_000_000))

    def timed(df: DataFrame, columns: list[str], v: Column, kind: int, ask: bool) -> DataFrame:
        return df.select(*columns, _epoch_micros(F.col(ts), ts_type(df, ts)).alias("__us"), F.lit(kind).alias("__kind"),
                         v.cast("double").alias("__v"), F.lit(ask).alias("__ask"))

    columns = list(dict.fromkeys([*names, *order])) if points is None else list(dict.fromkeys([key, *order]))
    values = timed(events, columns, F.col(value), EVENT, points is None)
    instants = values if points is None else timed(points, names, F.lit(None), POINT, True)
    placed = F.col("__us").isNotNull()
    second = F.lit(1_000_000).cast("bigint")
    start = F.floor((F.col("__us") - span) / second).cast("bigint") * second
    starts = instants.where(placed).select(key, start.alias("__us")).distinct().select(
        key, "__us", F.lit(MARK).alias("__kind"), F.lit(None).cast("double").alias("__v"), F.lit(False).alias("__ask"))
    sequence = values.where(placed).unionByName(starts, allowMissingColumns=True)
    if points is not None:
        sequence = sequence.unionByName(instants.where(placed), allowMissingColumns=True)
    ties = [c for c in order if c not in (key, ts)]
    # a start for each instant at most
    rows = values.count() * 2 if points is None else values.count() + instants.count() * 2
    order = [key, "__us", "__kind", *ties]
    chunks = cut_by_range(sequence, order, "__b", CHUNK_ROWS, rows).sortWithinPartitions(
        *[F.col(c).asc_nulls_first() for c in order])
    kinds = {f.name: f.dataType.simpleString() for f in chunks.schema.fields}
    given = ", ".join(f"`{c}` {kinds[c]}" for c in names)
    ship_package(spark)
    found = chunks.mapInArrow(
        _chunk_lists(key, names, span, n),
        f"{given}, __b bigint, __kind int, __start bigint, __closed boolean, __tops array<double>, avg_top double")
    path = scratch(spark)
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)

    asked_rows = found.where(F.col("__kind") == EVENT)
    closed = asked_rows.where("__closed").select(*names, "avg_top")
    marks = found.where(F.col("__kind") == MARK).select(F.col(key).alias("__mk"), F.col("__start").alias("__ms"),
                                                        F.col("__b").alias("__from"), F.col("__tops").alias("__end"))
    opened = asked_rows.where(~F.col("__closed")).join(
        marks, F.col(key).eqNullSafe(F.col("__mk")) & (F.col("__start") == F.col("__ms"))).drop("__mk", "__ms")
    pairs = opened.where(F.col("__b") - F.col("__from") > 1).select(key, "__from", "__b").distinct()
    wholes = found.where(F.col("__kind") == WHOLE).select(F.col(key).alias("__k"), F.col("__b").alias("__cb"),
                                                        F.col("__tops").alias("__list"))
    between = (pairs.groupBy(key).cogroup(wholes.groupBy("__k"))
               .applyInPandas(_between(key, n), f"`{key}` {kinds[key]}, __from bigint, __b bigint, __mid array<double>")
               .select(F.col(key).alias("__pk"), F.col("__from").alias("__pf"), F.col("__b").alias("__pb"), "__mid"))
    merged = opened.join(between, F.col(key).eqNullSafe(F.col("__pk")) & (F.col("__from") == F.col("__pf"))
                         & (F.col("__b") == F.col("__pb")), "left")
    none = F.array().cast("array<double>")
    every = F.sort_array(F.concat("__end", F.coalesce("__mid", none), "__tops"), asc=False)
    total = F.aggregate("__tops", F.lit(0.0), lambda a, x: a + x)
    across = merged.select(*names, F.slice(every, 1, n).alias("__tops")).select(
        *names, F.try_divide(total, F.size("__tops")).alias("avg_top"))
    average = F.col("avg_top")
    out = closed.unionByName(across).select(*names, (F.round(average, digits) if digits is not None else average).alias("avg_top"))
    alone = instants.where(~placed).select(*names, F.lit(None).cast("double").alias("avg_top"))
    return out.unionByName(alone)
