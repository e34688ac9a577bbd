"""Time-series choices: trailing top-n averages, cheapest option under a
limit in preference order, choice severity, failure streaks."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.time import as_of_instant, instant_literal, lookback_start, ts_type
from tessera.operators.matching import active_at, check_free
from tessera.operators.sequence import in_chunks
from tessera.session import ship_package


def _keys(k: str | Sequence[str]) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def top_n_rows(df: DataFrame, keys: Sequence[str], value: str, n: int) -> DataFrame:
    """The n largest ``value`` rows per key (ties broken arbitrarily).

    ``row_number() <= n`` is planned with a partial ``WindowGroupLimit``
    before the shuffle: each task forwards at most n rows per key, so a key
    holding a third of all rows still moves only n rows per task.
    """
    check_free(df, ["__rn"])
    w = Window.partitionBy(*keys).orderBy(F.desc(value))
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def _in_window(ts: Column, as_of: str, hours: float, dtype: str, upper: bool = True) -> Column:
    """``as_of - hours`` (cut to seconds) <= ts <= ``as_of``: literal bounds,
    pushed into the Parquet scan. ``upper=False`` when ``as_of`` is the
    table's own latest ``ts`` (no row lies beyond it)."""
    lower = ts >= lookback_start(as_of, hours, dtype)
    return (lower & (ts <= instant_literal(as_of, dtype))) if upper else lower


def _round(c: Column, digits: int | None) -> Column:
    return F.round(c, digits) if digits is not None else c


def trailing_topn_avg(prices: DataFrame, keys: str | Sequence[str], value: str, ts: str,
                      hours: float = 12.0, n: int = 10, as_of=None,
                      digits: int | None = None, fill_empty: bool = False) -> DataFrame:
    """Average of the n largest values per key since ``as_of - hours``.

    The window start is cut to whole seconds and inclusive, and the window
    ends at ``as_of`` (inclusive: later rows are not seen). ``as_of``
    defaults to the latest ``ts`` of the table. Both bounds are literals,
    pushed into the Parquet scan. Output ``(keys..., avg_top)``.

    A key with no value in the window has no row, unless ``fill_empty``:
    then every key of the table is reported, with 0 for an empty window
    (this costs one more pass over the key columns, partially aggregated).
    """
    keys = _keys(keys)
    given = as_of is not None
    as_of = as_of_instant(prices, ts, as_of)
    if as_of is None:
        return prices.select(*keys, F.lit(None).cast("double").alias("avg_top")).limit(0)
    dtype = ts_type(prices, ts)
    recent = prices.where(_in_window(F.col(ts), as_of, hours, dtype, given)).select(*keys, value)
    top = top_n_rows(recent, keys, value, n)
    avg_top = top.groupBy(*keys).agg(_round(F.avg(value), digits).alias("avg_top"))
    if not fill_empty:
        return avg_top
    every_key = prices.select(*keys).distinct()
    a = avg_top.select(*[F.col(k).alias(f"__{k}") for k in keys], "avg_top")
    on = None
    for k in keys:  # null-safe: a null key keeps its own average
        c = every_key[k].eqNullSafe(a[f"__{k}"])
        on = c if on is None else on & c
    return (every_key.join(a, on, "left")
            .select(*keys, F.coalesce("avg_top", F.lit(0.0)).alias("avg_top")))


def option_prices(prices: DataFrame, grp: str, opt: str, value: str, ts: str, as_of,
                  hist_hours: float = 12.0, hist_n: int = 10,
                  recent_hours: float = 6.0, recent_n: int = 2,
                  upper: bool = True) -> DataFrame:
    """Worst-case price per (group, option): the larger of the average of the
    ``hist_n`` highest values in the last ``hist_hours`` and of the
    ``recent_n`` highest in the last ``recent_hours`` (0 for an empty window).

    One scan of the longer window. Per (group, option) the highest values of
    its older and of its recent rows are kept, as many as either average can
    need (bounded per task before the shuffle), and one aggregate takes both
    averages from these few.
    """
    dtype = ts_type(prices, ts)
    keys = [grp, opt]
    check_free(prices.select(*dict.fromkeys([*keys, value, ts])), ["__h", "__r", "__rn"])

    def within(hours: float) -> Column:
        return _in_window(F.col(ts), as_of, hours, dtype, upper)

    rows = (prices.where(within(max(hist_hours, recent_hours)))
            .select(*keys, value, within(hist_hours).alias("__h"), within(recent_hours).alias("__r")))
    kept = top_n_rows(rows, [*keys, "__h", "__r"], value, max(hist_n, recent_n))

    def avg_top(flag: str, n: int) -> Column:
        best = F.slice(F.sort_array(F.collect_list(F.when(F.col(flag), F.col(value).cast("double"))), asc=False), 1, n)
        total = F.aggregate(best, F.lit(0.0), lambda a, x: a + x)
        return F.coalesce(F.try_divide(total, F.size(best)), F.lit(0.0))

    agg = kept.groupBy(*keys).agg(avg_top("__h", hist_n).alias("hist_price"),
                                  avg_top("__r", recent_n).alias("recent_price"))
    return agg.withColumn("price", F.greatest("recent_price", "hist_price"))


def cheapest_under_limit(prices: DataFrame, preferences: DataFrame, grp: str, opt: str,
                         value: str, ts: str, exclusions: DataFrame | None = None,
                         pos: str = "pos", max_price: str = "max_price", as_of=None,
                         margin: float = 0.8, hist_hours: float = 12.0, hist_n: int = 10,
                         recent_hours: float = 6.0, recent_n: int = 2,
                         exclusion_ttl_hours: float = 3.0,
                         digits: int | None = None, with_severity: bool = False,
                         options: DataFrame | None = None) -> DataFrame:
    """Walk groups in preference order and pick the first affordable option.

    For each row of ``preferences`` (``pos``, group, ``max_price``), in
    ascending ``pos`` (ties: by group, then limit): the cheapest (by price,
    then option) non-excluded option with a positive price is accepted when
    it costs strictly less than ``max_price * margin``. A group with a null
    limit accepts its first non-excluded option (by option order) whether it
    has a price or not; its options are those of ``options`` (``grp``,
    ``opt``), or, when that is not given, all that ``prices`` ever names.
    The first accepted row wins; no row when none qualifies.

    ``exclusions`` rows (``opt``, ``grp`` or both, plus ``ts``) rule options
    out while alive at ``as_of``: ``ts <= as_of < ts + ttl``. Output ``(pos,
    grp, opt, price)``, price null if the option has none; ``as_of``
    defaults to the latest ``ts`` of ``prices``. Prices in the window that
    are null count as none.

    The per-option argmin is a ``min`` over a struct (an aggregate, no
    window), and the final choice is one ``orderBy().limit(1)``.
    ``with_severity`` adds the ``severity`` of the choice (see ``severity``)
    from its 1-based index among all rows of ``preferences`` in that order.
    """
    given = as_of is not None
    as_of = as_of_instant(prices, ts, as_of)
    on = [c for c in (grp, opt) if exclusions is not None and c in exclusions.columns]
    if exclusions is not None and not on:
        raise ValueError(f"exclusions need a column {grp!r} or {opt!r}; they have {exclusions.columns}")

    def allowed(df: DataFrame) -> DataFrame:
        if exclusions is None or as_of is None:
            return df
        now = instant_literal(as_of, ts_type(prices, ts))
        alive = active_at(exclusions, ts, now, exclusion_ttl_hours)
        return df.join(alive.select(*on).distinct(), on, "left_anti")

    # the preference list is a small parameter table
    index = F.row_number().over(Window.orderBy(F.col(pos), F.col(grp), F.col(max_price)))
    prefs = preferences.select(F.col(pos).alias("__pos"), grp, F.col(max_price).alias("__mx"), index.alias("__i"))
    if as_of is None:  # no prices at all
        p = prices.select(grp, opt, F.lit(None).cast("double").alias("price")).limit(0)
    else:
        p = option_prices(prices, grp, opt, value, ts, as_of, hist_hours, hist_n, recent_hours, recent_n,
                          upper=given).select(grp, opt, "price")
    limited = (allowed(p).join(prefs.where(F.col("__mx").isNotNull()), grp)
               .where(F.col("price") > 0)
               .withColumn("__sp", F.col("price")))
    free = prefs.where(F.col("__mx").isNull())
    listed = (options if options is not None else prices).select(grp, opt)
    first = allowed(listed).groupBy(grp).agg(F.min(opt).alias(opt))  # the only one that can be chosen
    priced = p.select(F.col(grp).alias("__g"), F.col(opt).alias("__o"), "price")
    any_price = (first.join(free, grp)
                 .join(priced, F.col(grp).eqNullSafe(F.col("__g")) & F.col(opt).eqNullSafe(F.col("__o")), "left")
                 .drop("__g", "__o").withColumn("__sp", F.lit(0.0)))
    cand = limited.unionByName(any_price)
    best = cand.groupBy("__i").agg(F.min(F.struct(
        F.col("__sp").alias("sp"), F.col(opt).alias("o"), F.col("price").alias("p"), F.col("__pos").alias("pos"),
        F.col(grp).alias("g"), F.col("__mx").alias("mx"))).alias("b"))
    accepted = best.where(F.col("b.mx").isNull() | (F.col("b.p") < F.col("b.mx") * F.lit(margin)))
    chosen = accepted.orderBy("__i").limit(1)
    out = [F.col("b.pos").alias(pos), F.col("b.g").alias(grp), F.col("b.o").alias(opt),
           _round(F.col("b.p"), digits).alias("price")]
    if with_severity:
        n_prefs = preferences.select(F.count(F.lit(1))).scalar()
        out.append(severity(F.col("__i"), n_prefs).alias("severity"))
    return chosen.select(*out)


def severity(pos: Column, n: Column) -> Column:
    """Label of choosing preference ``pos`` (1-based) of ``n``.

    Fixed labels: none for the first preference; CRITICAL for the last one;
    CRITICAL when the 0-based index is at least ``n // 2``; WARNING else.
    """
    return (F.when(pos == 1, F.lit(None).cast("string"))
            .when(pos == n, F.lit("CRITICAL"))
            .when(pos - 1 >= F.floor(n / 2), F.lit("CRITICAL"))
            .otherwise(F.lit("WARNING")))


def choice_severity(choices: DataFrame, pos: str = "pos", n: str | int | None = None) -> DataFrame:
    """Add ``severity`` to rows holding a chosen position ``pos`` (the 1-based
    index of the choice in the preference list).

    ``n`` (number of preferences) is a column name, an int, or, when
    omitted, the number of rows of ``choices`` as a scalar subquery (one
    count, inlined as a value; no join and no global window).
    """
    if n is None:
        n_col = choices.select(F.count(F.lit(1))).scalar()
    elif isinstance(n, int):
        n_col = F.lit(n)
    else:
        n_col = F.col(n)
    return choices.withColumn("severity", severity(F.col(pos), n_col))


def failure_streak(events: DataFrame, key: str, ts: str, failed: Column,
                   order_by: Sequence[str] = (), cap: int | None = 2,
                   keep: Sequence[str] = (), healthy: Column | None = None) -> DataFrame:
    """Consecutive-failure counter per key, reported on each failing row.

    Rows of a key are taken in ``(ts, *order_by)`` order, null keys as one
    key. The counter goes up by one per failure (``failed`` true) and back
    to 0 on a success (``failed`` false); a row whose outcome is null
    changes nothing. With ``cap`` the counter also restarts after a failure
    at which it reached ``cap``; with ``healthy`` only if that column is
    true there (else it goes on counting, beyond ``cap``). Output: ``keep``
    columns, ``key`` and ``streak`` (BIGINT) for the failing rows.

    There is no one task per key: rows are cut into chunks by row counts
    (see ``in_chunks``), chunks are counted on their own, and one row per
    chunk and key carries what is needed to go on in the next one. Rows that
    agree in key, ``ts`` and all of ``order_by`` are in no defined order.
    """
    columns = list(dict.fromkeys([*keep, key, ts, *order_by]))
    check_free(events.select(*columns),
               ["__f", "__b", "__lf", "__ls", "__nf", "__bs", "__off", "__prev", "__k", "__ob", "__ok"])
    order = [F.col(c).asc_nulls_first() for c in (ts, *order_by)]
    if healthy is not None and cap:
        rows = events.select(*columns, failed.alias("__f"), F.coalesce(healthy, F.lit(False)).alias("__ok"))
        return _streak_by_health(in_chunks(rows, [key, ts, *order_by]), key, [ts, *order_by], cap,
                                 list(dict.fromkeys([*keep, key])))
    rows = in_chunks(events.select(*columns, failed.alias("__f")), [key, ts, *order_by])
    running = Window.partitionBy(key, "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding,
                                                                         Window.currentRow)
    is_fail = F.coalesce(F.col("__f"), F.lit(False))
    is_success = F.coalesce(~F.col("__f"), F.lit(False))
    # failures so far in the chunk; its value at a success row (the count
    # never decreases, so the latest success holds the running maximum)
    at_success = F.when(is_success, F.col("__lf"))
    local = (rows.withColumn("__lf", F.sum(is_fail.cast("bigint")).over(running))
             .withColumn("__ls", F.max(at_success).over(running)))
    per_chunk = local.groupBy(key, "__b").agg(F.sum(is_fail.cast("bigint")).alias("__nf"),
                                             F.max(at_success).alias("__bs"))
    wb = Window.partitionBy(key).orderBy("__b")
    offsets = (per_chunk
               .withColumn("__off", F.sum("__nf").over(wb.rowsBetween(Window.unboundedPreceding,
                                                                    Window.currentRow)) - F.col("__nf"))
               .withColumn("__prev", F.max(F.col("__off") + F.col("__bs"))
                           .over(wb.rowsBetween(Window.unboundedPreceding, -1)))
               .select(F.col(key).alias("__k"), F.col("__b").alias("__ob"), "__off", "__prev"))
    fails = local.where(is_fail).join(
        offsets, F.col(key).eqNullSafe(F.col("__k")) & (F.col("__b") == F.col("__ob")))
    at_last_success = F.coalesce(F.col("__off") + F.col("__ls"), F.col("__prev"), F.lit(0).cast("bigint"))
    run = F.col("__off") + F.col("__lf") - at_last_success
    streak = ((run - 1) % cap + 1) if cap else run
    return fails.select(*dict.fromkeys([*keep, key]), streak.cast("bigint").alias("streak"))


def _walk(outcome: list, ok: list, state: int, cap: int) -> tuple[list[int], int, bool]:
    """Streaks at the failures of one sequence, its end state, and whether it ever went back to 0."""
    out, reset = [], False
    for f, h in zip(outcome, ok):
        if f is True:
            state += 1
            out.append(state)
            if h and state >= cap:
                state, reset = 0, True
        elif f is False:
            state, reset = 0, True
    return out, state, reset


def _streak_by_health(rows: DataFrame, key: str, order: list[str], cap: int, out: list[str]) -> DataFrame:
    """Streaks that depend on each row's health, chunk by chunk.

    Chunks are ranges of (key, order), so only a chunk's first key can go on
    from the chunk before. For a chunk's first and last key a first pass
    tells the end state for each state below ``cap``; states from ``cap`` -
    1 on go back to 0 at the same rows, and else grow alike. One row per
    such key and chunk is chained, and a second pass counts.
    """
    ship_package(rows.sparkSession)
    schema = rows.schema
    key_type = schema[key].dataType.simpleString()

    def sequences(pdf: pd.DataFrame) -> list[tuple[object, pd.DataFrame]]:
        pdf = pdf.sort_values([key, *order], kind="stable", na_position="first")
        null = pdf[key].isna()
        change = (pdf[key] != pdf[key].shift()) & ~(null & null.shift(fill_value=False))
        return [(part[key].iat[0], part) for _, part in pdf.groupby(change.cumsum().to_numpy())]

    def outcomes(part: pd.DataFrame) -> tuple[list, list]:
        return [None if pd.isna(f) else bool(f) for f in part["__f"]], [bool(h) for h in part["__ok"]]

    def ends(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = sequences(pdf)
        found = []
        for k, part in (parts if len(parts) < 2 else [parts[0], parts[-1]]):
            f, h = outcomes(part)
            walks = [_walk(f, h, s, cap) for s in range(cap)]
            found.append((k, int(part["__b"].iat[0]), [w[1] for w in walks], walks[-1][2], sum(x is True for x in f)))
        return pd.DataFrame(found, columns=["k", "b", "ends", "reset", "fails"])

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        state, found = 0, []
        for k, b, to, reset, fails in pdf.sort_values("b").itertuples(index=False):
            found.append((k, b, state))
            state = int(to[state]) if state < cap else int(to[cap - 1]) if reset else state + int(fails)
        return pd.DataFrame(found, columns=["k", "b", "state"])

    def count(pdf: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        at = {None if pd.isna(k) else k: s for k, s in zip(states["k"], states["state"])}
        found = []
        for k, part in sequences(pdf):
            f, h = outcomes(part)
            streaks, _, _ = _walk(f, h, at.get(None if pd.isna(k) else k, 0), cap)
            fails = part[[x is True for x in f]]
            found.append(fails[out].assign(streak=streaks))
        return pd.concat(found) if found else pd.DataFrame(columns=[*out, "streak"])

    maps = rows.groupBy("__b").applyInPandas(
        ends, f"k {key_type}, b bigint, ends array<bigint>, reset boolean, fails bigint")
    states = maps.groupBy("k").applyInPandas(chain, f"k {key_type}, b bigint, state bigint")
    result = ", ".join(f"`{c}` {schema[c].dataType.simpleString()}" for c in out) + ", streak bigint"
    return (rows.groupBy("__b").cogroup(states.withColumnRenamed("b", "__b").groupBy("__b"))
            .applyInPandas(count, result))
