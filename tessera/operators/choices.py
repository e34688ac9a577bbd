"""The choice of ``cheapest_under_limit`` at each of many decision times."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.time import ts_type
from tessera.operators.matching import _epoch_micros, check_free, ttl_exclude
from tessera.operators.sequence import begins, cut_by_range, in_chunks
from tessera.operators.sliding import trailing_topn_series
from tessera.session import scratch, ship_package

CHUNK_ROWS = 100_000  # price changes and questions that one task sweeps, about
STEP_ROWS = 500_000  # price changes, in the order of options, that one task links, about
LEVELS = 40  # two to the power of so many chunks are provided for
_HOUR = 3_600_000_000


def _written(df: DataFrame) -> DataFrame:
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def price_steps(prices: DataFrame, grp: str, opt: str, value: str, ts: str,
                exclusions: DataFrame | None = None, groups: Sequence[str] | None = None,
                hist_hours: float = 12.0, hist_n: int = 10, recent_hours: float = 6.0, recent_n: int = 2,
                exclusion_ttl_hours: float = 3.0) -> DataFrame:
    """The price of each option as a step function: (``grp``, ``opt``, ``at``, ``price``).

    One row for each instant (``at``, microseconds) at which the price of
    ``option_prices`` can change: a value comes, or leaves one of the two
    windows; or an exclusion begins or ends. The price is that of
    ``option_prices`` as of then, and holds until the option's next row; 0
    while the option has no positive price or is excluded. Rows without a
    time are ignored.
    """
    chosen = prices if groups is None else prices.where(F.col(grp).isin(list(groups)))
    rows = _written(chosen.select(grp, opt, F.col(value).alias("value"), _epoch_micros(F.col(ts), ts_type(prices, ts)).alias("at"),
                                  F.to_json(F.struct(grp, opt)).alias("key")).where(F.col("at").isNotNull()))
    second = F.lit(1_000_000).cast("bigint")
    leaves = F.floor(F.col("at") / second).cast("bigint") * second + second  # and a window's length later it is out
    spans = [int(round(h * _HOUR)) for h in (hist_hours, recent_hours)]
    moments = rows.select(grp, opt, "key", F.explode(F.array("at", *[leaves + s for s in spans])).alias("at"))
    out, keyed = None, None
    if exclusions is not None:
        on = [c for c in (grp, opt) if c in exclusions.columns]
        if not on:
            raise ValueError(f"exclusions need a column {grp!r} or {opt!r}; they have {exclusions.columns}")
        ttl = int(round(exclusion_ttl_hours * _HOUR))
        out = exclusions.select(*[F.col(c).alias(f"x_{c}") for c in on],
                                _epoch_micros(F.col(ts), ts_type(exclusions, ts)).alias("x_at")).where("x_at is not null")
        options = rows.select(grp, opt, "key").distinct()
        met = F.lit(True)
        for c in on:
            met = met & F.col(c).eqNullSafe(F.col(f"x_{c}"))
        # an exclusion by option alone meets it once for each group it is in
        excluded = _written(options.join(out, met).select(grp, opt, "key", "x_at").distinct())
        moments = moments.unionByName(excluded.select(grp, opt, "key", F.explode(F.array("x_at", F.col("x_at") + ttl)).alias("at")))
        keyed = excluded.select("key", F.col("x_at").alias("at"))
    moments = _written(moments.distinct())
    # at an instant of an exclusion the price is 0, whatever the averages are
    free = moments if keyed is None else _written(ttl_exclude(moments, keyed, "key", "at", exclusion_ttl_hours))

    lately = trailing_topn_series(rows, "key", "value", "at", recent_hours, recent_n, keep=[grp, opt, "at"], points=free)
    lately = _written(lately.withColumnRenamed("avg_top", "__recent"))
    both = trailing_topn_series(rows, "key", "value", "at", hist_hours, hist_n, keep=[grp, opt, "at", "__recent"], points=lately)
    steps = moments.select(grp, opt, "at", F.lit(0.0).alias("price")).unionByName(
        both.select(grp, opt, "at", F.greatest("__recent", "avg_top").alias("price")))
    return _written(steps.groupBy(grp, opt, "at").agg(F.max("price").alias("price")))


def _befores(by: list[str]):
    """Each row of a chunk in order with the price and chunk of its option's row before, as far as the chunk has it."""

    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        rows = pa.Table.from_batches(batches)
        n = rows.num_rows
        before = pa.array(np.arange(-1, n - 1), mask=begins(rows, by))
        at = np.arange(n)
        for name, column in {"__local": rows.column("price").take(before), "__from": rows.column("__b").take(before),
                             "__first": pa.array(at == 0), "__final": pa.array(at == n - 1)}.items():
            rows = rows.append_column(name, column)
        yield from rows.combine_chunks().to_batches()

    return run


def _with_previous(steps: DataFrame, grp: str, opt: str) -> DataFrame:
    """Steps (with their chunk ``__b``) and the price and chunk of the option's step before (null for its first).

    One pass in the order of options; only the first row of a chunk may have to look into an earlier one.
    """
    order = [grp, opt, "at"]
    cut = cut_by_range(steps, order, "__c", STEP_ROWS, steps.count()).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
    kinds = dict(cut.dtypes)
    ship_package(steps.sparkSession)
    local = _written(cut.mapInArrow(_befores([grp, opt]), ", ".join(f"`{c}` {k}" for c, k in kinds.items())
                                    + ", __local double, __from bigint, __first boolean, __final boolean"))
    # of each chunk its last row, and its first, which asks for the last row of its option before it
    ends = (local.where("__final").select(grp, opt, "__c", F.lit(1).alias("__end"), F.struct("price", "__b").alias("__last"))
            .unionByName(local.where("__first").select(grp, opt, "__c", F.lit(0).alias("__end")), allowMissingColumns=True))
    carried = (ends.withColumn("__carry", F.lag("__last").over(Window.partitionBy(grp, opt).orderBy("__c", "__end")))
               .where((F.col("__end") == 0) & F.col("__carry").isNotNull()).select(F.col("__c").alias("__k"), "__carry"))
    joined = local.join(F.broadcast(carried), F.when(F.col("__first"), F.col("__c")) == F.col("__k"), "left")
    return joined.select(grp, opt, "at", "price", "__b",
                         F.coalesce("__local", F.col("__carry").getField("price")).alias("__was"),
                         F.coalesce("__from", F.col("__carry").getField("__b")).alias("__since"))


def _covering(steps: DataFrame, chunks: DataFrame, grp: str, opt: str) -> DataFrame:
    """(``grp``, ``__b``, best): the cheapest price that holds through the whole of a chunk.

    A price that spans chunks is given to the few dyadic ranges of chunks
    that make up its span; each range keeps its least, and each chunk looks
    at the ranges that it lies in.
    """
    level = F.col("__level")
    power = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
    whole = (steps.where((F.col("__was") > 0) & (F.col("__b") - F.col("__since") > 1))
             .select(grp, F.struct(F.col("__was").alias("price"), F.col(opt).alias("opt")).alias("price"),
                     (F.col("__since") + 1).alias("__lo"), F.col("__b").alias("__hi"))
             .withColumn("__level", F.explode(F.sequence(F.lit(0), F.length(F.bin(F.col("__hi") - F.col("__lo")))))))
    lo, hi = F.floor((F.col("__lo") + power - 1) / power), F.floor(F.col("__hi") / power)
    odd = F.lit(1).cast("bigint")
    ranges = (whole.withColumns({"__lo": lo, "__hi": hi}).where("__lo < __hi")
              .select(grp, "price", "__level", F.explode(F.array(
                  F.when(F.col("__lo").bitwiseAND(odd) == 1, F.col("__lo")),
                  F.when(F.col("__hi").bitwiseAND(odd) == 1, F.col("__hi") - 1))).alias("__node"))
              .where(F.col("__node").isNotNull()))
    least = ranges.groupBy(grp, "__level", "__node").agg(F.min("price").alias("price"))
    asked = (chunks.select(grp, "__b").distinct()
             .withColumn("__level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
             .withColumn("__node", F.call_function("shiftright", F.col("__b"), level)))
    return asked.join(least, [grp, "__level", "__node"]).groupBy(grp, "__b").agg(F.min("price").alias("best"))


def _sweep(grp: str, keep: list[str], given: list[str]):
    """One chunk in time order: at each question the cheapest option of its group, if any has a price."""

    def rank(price: float, opt) -> tuple:
        null = opt is None or opt != opt
        return (price, not null, 0 if null else opt)

    def run(rows: pd.DataFrame, covers: pd.DataFrame) -> pd.DataFrame:
        found = []
        over = {g: rank(p, o) for g, p, o in zip(covers["__cg"], covers["__cp"], covers["__co"])}
        for g, part in rows.groupby(grp, sort=False):
            part = part.sort_values(["at", "__kind"], kind="stable")
            columns = zip(part["__kind"], part["opt"], part["price"], part["__was"], part["__in"], part["__row"])
            table = list(columns)
            now = {}  # the price of each option that changes in this chunk
            for kind, opt, _, was, before, _ in table:
                if kind == 0 and before and was > 0:
                    now[rank(0.0, opt)[1:]] = was
            heap = [(p, *o) for o, p in now.items()]
            heapq.heapify(heap)
            always = over.get(g)
            for kind, opt, price, _, _, row in table:
                if kind == 0:
                    entry = rank(price, opt)
                    now[entry[1:]] = price
                    if price > 0:
                        heapq.heappush(heap, entry)
                    continue
                while heap and now[heap[0][1:]] != heap[0][0]:
                    heapq.heappop(heap)  # no longer its price
                best = min([x for x in (heap[0] if heap else None, always) if x is not None], default=None)
                if best is not None:
                    found.append((row, best[0], best[2] if best[1] else None))
        hits = pd.DataFrame(found, columns=["__row", "price", "opt"])
        return rows[["__row", *given]].merge(hits, on="__row")[[*given, "opt", "price"]]

    return run


def choices_over_time(prices: DataFrame, decisions: DataFrame, preferences: Sequence[tuple], grp: str, opt: str,
                      value: str, ts: str, keep: Sequence[str], exclusions: DataFrame | None = None,
                      margin: float = 0.8, hist_hours: float = 12.0, hist_n: int = 10, recent_hours: float = 6.0,
                      recent_n: int = 2, exclusion_ttl_hours: float = 3.0, digits: int | None = None) -> DataFrame:
    """What ``cheapest_under_limit`` chooses as of each row of ``decisions``, in one sweep.

    ``preferences`` are (pos, group, max_price), a short list in which every
    group has a limit. Per decision (identified by its ``keep`` columns; at
    its ``ts``): the first preference, by pos, whose cheapest option costs
    less than ``max_price * margin``, as ``pos``, ``grp``, ``opt`` and
    ``price``; these are null if there is none, or the decision has no time.
    Options excluded at that time (see ``cheapest_under_limit``) don't count.

    No decision is paired with options. Prices are made step functions
    (:func:`price_steps`); steps and decisions are put in one sequence by
    group and time and cut into chunks by row counts. A chunk is swept once:
    the options whose price changes in it are in a heap, and the cheapest of
    those whose price holds throughout it is known beforehand from dyadic
    ranges of chunks. So a hot group is spread over tasks, and what is
    carried between chunks does not grow with the number of options.
    """
    if any(p[2] is None for p in preferences):
        raise ValueError("every preference needs a limit here")
    keep = list(keep)
    check_free(decisions.select(*keep), ["at", "pos", "opt", "price", "grp", "key", grp, opt, "max_price", "__b", "__kind", "__row"])
    spark = prices.sparkSession
    steps = price_steps(prices, grp, opt, value, ts, exclusions, [p[1] for p in preferences], hist_hours, hist_n,
                        recent_hours, recent_n, exclusion_ttl_hours)
    wanted = F.array(*[F.struct(F.lit(p).alias("pos"), F.lit(g).alias(grp), F.lit(float(m)).alias("max_price"))
                       for p, g, m in sorted(preferences, key=lambda p: p[0])])
    times = decisions.select(*keep, _epoch_micros(F.col(ts), ts_type(decisions, ts)).alias("at"))
    questions = (times.where(F.col("at").isNotNull()).withColumn("want", F.explode(wanted))
                 .select(*keep, "at", "want.*", F.lit(1).alias("__kind")))
    sequence = steps.withColumn("__kind", F.lit(0)).unionByName(questions, allowMissingColumns=True)
    chunks = in_chunks(sequence, [grp, "at", "__kind", opt, *keep], rows_per_chunk=CHUNK_ROWS,
                       rows=steps.count() + decisions.count() * len(preferences))
    linked = _with_previous(chunks.where("__kind = 0").select(grp, opt, "at", "price", "__b"), grp, opt)
    covers = _covering(linked, chunks, grp, opt)
    rows = (linked.withColumns({"__kind": F.lit(0), "__in": F.coalesce(F.col("__since") < F.col("__b"), F.lit(False))})
            .drop("__since")
            .unionByName(chunks.where("__kind = 1").drop(opt, "price"), allowMissingColumns=True))
    rows = rows.withColumnRenamed(opt, "opt").withColumn("__row", F.monotonically_increasing_id())
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    given = [*keep, "pos", grp, "max_price"]
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*given, "opt", "price"])
    ship_package(spark)
    known = covers.select(F.col("__b").alias("__cb"), F.col(grp).alias("__cg"), F.col("best.price").alias("__cp"),
                          F.col("best.opt").alias("__co"))
    best = (rows.groupBy("__b").cogroup(known.groupBy("__cb")).applyInPandas(_sweep(grp, keep, given), schema))
    shown = F.round("price", digits) if digits is not None else F.col("price")
    accepted = (best.where(F.col("price") < F.col("max_price") * F.lit(margin))
                .groupBy(*keep).agg(F.min(F.struct("pos", F.col(grp).alias("g"), F.col("opt").alias("o"), shown.alias("p"))).alias("c")))
    same: Column = F.lit(True)
    for c in keep:
        same = same & F.col(c).eqNullSafe(F.col(f"__k_{c}"))
    named = accepted.select(*[F.col(c).alias(f"__k_{c}") for c in keep], "c")
    return times.join(named, same, "left").select(
        *keep, F.col("c.pos").alias("pos"), F.col("c.g").alias(grp), F.col("c.o").alias(opt), F.col("c.p").alias("price"))
