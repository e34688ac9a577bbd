"""Time helpers: reference instant and look-back bounds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def ts_type(df: DataFrame, ts: str) -> str:
    """``timestamp_ntz`` or ``timestamp``: the SQL type name of column ``ts``."""
    return df.schema[ts].dataType.simpleString()


def as_of_instant(df: DataFrame, ts: str, as_of=None) -> str | None:
    """Reference instant for a time-dependent job, as text for a literal.

    ``as_of`` may be a ``datetime`` or an ISO string; when omitted it is the
    latest ``ts`` of the table (never the wall clock, so reruns agree).
    For a zoned ``timestamp`` column the text carries its UTC offset, so the
    instant survives the round trip even in a daylight-saving overlap; for
    a ``timestamp_ntz`` column it is the wall-clock reading (an aware
    ``datetime`` is first taken to UTC). Returns None for an empty table.
    """
    ntz = ts_type(df, ts) == "timestamp_ntz"
    if as_of is not None:
        if ntz:
            text = as_of.isoformat() if isinstance(as_of, dt.datetime) else str(as_of)
            return _parse_wall_clock(text).isoformat(sep=" ")
        return as_of.isoformat(sep=" ") if isinstance(as_of, dt.datetime) else str(as_of)
    fmt = _FMT if ntz else _FMT + "XXX"
    return df.agg(F.date_format(F.max(ts), fmt).alias("m")).first()["m"]


def instant_literal(as_of: str, dtype: str = "timestamp_ntz") -> Column:
    """A timestamp literal of type ``dtype`` for ``as_of`` text."""
    return F.lit(as_of).cast(dtype)


def seconds_interval(seconds: float) -> Column:
    return F.expr(f"make_dt_interval(0, 0, 0, {float(seconds)!r})")


def lookback_start(as_of: str, hours: float, dtype: str = "timestamp_ntz") -> Column:
    """``as_of - hours``, cut to whole seconds: an inclusive lower bound.

    A literal, so a filter on it reaches the Parquet scan as a pushed filter
    and skips row groups outside the window. For ``timestamp_ntz`` the bound
    is worked out as a wall-clock reading (no time zone involved, so no
    daylight-saving gap can move it); for a zoned ``timestamp`` it is the
    instant ``hours`` of real time earlier.
    """
    if dtype == "timestamp_ntz":
        start = _parse_wall_clock(as_of) - dt.timedelta(microseconds=int(round(hours * 3600e6)))
        return F.lit(start.replace(microsecond=0).isoformat(sep=" ")).cast(dtype)
    start = instant_literal(as_of, dtype) - seconds_interval(hours * 3600)
    return F.date_trunc("second", start).cast(dtype)


def _parse_wall_clock(text: str) -> dt.datetime:
    """A naive wall-clock datetime from ISO text; an offset is taken to UTC."""
    d = dt.datetime.fromisoformat(text.strip())
    return d.astimezone(dt.timezone.utc).replace(tzinfo=None) if d.tzinfo else d
