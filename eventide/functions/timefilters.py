"""Time-range predicates of the reports and dashboard panels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_lit(value) -> Column:
    """A timestamp literal from a Column, ``datetime`` or ISO text."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast("timestamp")


def as_of_or_now(as_of=None) -> Column:
    return ts_lit(as_of) if as_of is not None else F.current_timestamp()


def hours_before(as_of, hours: int) -> Column:
    return as_of_or_now(as_of) - F.make_interval(hours=F.lit(hours))


def days_before(as_of, days: int) -> Column:
    return as_of_or_now(as_of) - F.make_interval(days=F.lit(days))


def since(c: str, as_of=None, hours: int = 24) -> Column:
    """``c >= as_of - hours`` (trailing range; ``as_of`` defaults to now)."""
    return F.col(c) >= hours_before(as_of, hours)


def time_filter(c: str, frm, to) -> Column:
    """Dashboard range macro: ``c BETWEEN from AND to`` (both ends inclusive)."""
    return F.col(c).between(ts_lit(frm), ts_lit(to))


def strictly_between(c: str, frm, to) -> Column:
    """``c > from AND c < to``."""
    return (F.col(c) > ts_lit(frm)) & (F.col(c) < ts_lit(to))


# --- fixed values: relative range presets of the dashboard ------------------
RANGES = {
    "now-24h": dt.timedelta(hours=24),
    "now-7d": dt.timedelta(days=7),
    "now-30d": dt.timedelta(days=30),
}


def resolve_range(name: str, as_of: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    """A preset name -> ``(from, to)`` ending at ``as_of``."""
    return as_of - RANGES[name], as_of


def window_width_is(start: str, end: str, width: str) -> Column:
    """``end - start = INTERVAL width`` (e.g. ``'1 hour'``, ``'1 day'``)."""
    return (F.unix_micros(F.col(end)) - F.unix_micros(F.col(start))) == width_micros(width)


_UNIT_MICROS = {
    "second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def width_micros(width: str) -> int:
    """A width such as ``'15 minutes'`` in microseconds."""
    n, unit = width.split()
    return int(n) * _UNIT_MICROS[unit.rstrip("s")]


def aligned_to(c: str, width: str) -> Column:
    """Window starts that fall on a multiple of ``width`` since the epoch."""
    return F.unix_micros(F.col(c)) % width_micros(width) == 0
