"""Health check and retention (M1-M3).

Retention is a keep-filter. On a lake table the same rule deletes the folders
whose rows are all expired and rewrites those that hold both kinds, see
``lake.expire``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefilters import days_before, window_width_is


def flow_check(df: DataFrame, ts: str = "created_at") -> DataFrame:
    """Events seen, latest event time, and ``flowing`` when any arrived."""
    return (df.agg(F.count(F.lit(1)).alias("event_count"),
                   F.max(ts).alias("latest_event"))
              .withColumn("status", F.when(F.col("event_count") > 0, F.lit("flowing"))
                                     .otherwise(F.lit("no data"))))


def retain(df: DataFrame, ts_col: str, days: int, as_of=None) -> DataFrame:
    """Rows to keep: ``ts_col >= as_of - days``."""
    return df.filter(F.col(ts_col) >= days_before(as_of, days))


# --- fixed values: tiered retention (window width -> days kept) -------------
DEFAULT_TIERS = {"1 hour": 30, "1 day": 90}
RAW_EVENT_DAYS = 7


def tier_expired(tiers: dict[str, int] | None = None, as_of=None) -> Column:
    """Whether a metric row's window width has a tier that ended before it."""
    drop = F.lit(False)
    for width, days in (DEFAULT_TIERS if tiers is None else tiers).items():
        drop = drop | (window_width_is("window_start", "window_end", width)
                       & (F.col("window_end") < days_before(as_of, days)))
    return drop


def retain_tiered(m: DataFrame, tiers: dict[str, int] | None = None, as_of=None) -> DataFrame:
    """Metric rows to keep: a row whose window width has a tier is dropped
    once ``window_end`` is older than that tier; other widths are kept."""
    return m.filter(~tier_expired(tiers, as_of))
