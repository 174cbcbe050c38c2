"""Dashboard panel queries (D1-D7) as parameterised DataFrame functions.

``frm`` / ``to`` are the dashboard's time range (timestamps, ``datetime`` or
ISO text); ``as_of`` is "now" for the trailing 24 h of the reports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefilters import strictly_between, time_filter, ts_lit
from . import reports

BROADCAST_ROWS = 10_000
TOP_SERIES = 10


def _dates(df: DataFrame, frm, to, lo_shift: str | None = None,
           hi_shift: str | None = None) -> DataFrame:
    """On a lake table, add the ``window_date`` bounds implied by a time
    range so whole date partitions are pruned (exact: the date is derived
    from ``window_start``); the shifts widen the bounds by an interval."""
    if "window_date" not in df.columns:
        return df
    lo, hi = ts_lit(frm), ts_lit(to)
    if lo_shift:
        lo = lo - F.expr(f"INTERVAL {lo_shift}")
    if hi_shift:
        hi = hi + F.expr(f"INTERVAL {hi_shift}")
    return df.filter(F.col("window_date").between(F.to_date(lo), F.to_date(hi)))


def repository_activity(m: DataFrame, frm, to, as_of=None, k: int = TOP_SERIES) -> DataFrame:
    """(window_start as time, event_count) of the top-k repositories in range.

    The IN-subquery is a left-semi join against a k-row top list, broadcast where
    k bounds its size (no shuffle of the metric table); longer lists are joined as
    Spark sees fit.
    """
    top = reports.top_repositories(m, as_of).select("repo_id").limit(k)
    if k <= BROADCAST_ROWS:
        top = F.broadcast(top)
    return (_dates(m, frm, to).filter(time_filter("window_start", frm, to))
             .join(top, "repo_id", "left_semi")
             .select(F.col("window_start").alias("time"), "event_count")
             .orderBy("time", "event_count"))


def series_stats(df: DataFrame, c: str = "event_count") -> DataFrame:
    """Legend reducers of a series: mean, max, sum (one row)."""
    return df.agg(F.avg(c).alias("mean"), F.max(c).alias("max"),
                  F.sum(c).cast("bigint").alias("sum"))


def event_types(e: DataFrame, frm, to) -> DataFrame:
    """Events per type in range, largest first, with the pie's share in percent."""
    grouped = (_dates(e, frm, to).filter(time_filter("window_start", frm, to))
                .groupBy("event_type")
                .agg(F.sum("event_count").cast("bigint").alias("count")))
    return reports.with_share(grouped, "count").orderBy(
        F.col("count").desc(), "event_type")


def top_languages(lt: DataFrame, frm, to, k: int = TOP_SERIES) -> DataFrame:
    return (_dates(lt, frm, to).filter(time_filter("window_start", frm, to))
              .groupBy("language")
              .agg(F.sum("event_count").cast("bigint").alias("count"))
              .orderBy(F.col("count").desc(), "language")
              .limit(k))


def top_repositories(m: DataFrame, as_of=None, k: int = TOP_SERIES) -> DataFrame:
    return (reports.top_repositories(m, as_of).limit(k)
            .select("repo_name", "total_events", "total_stars", "total_forks",
                    "total_prs", "total_issues"))


def top_users(u: DataFrame, as_of=None, k: int = TOP_SERIES) -> DataFrame:
    return (reports.top_users(u, as_of).limit(k)
            .select("username", "total_events", "total_repos_contributed"))


def overall_trends(m: DataFrame, frm, to) -> DataFrame:
    # hour = start of the hour of window_start, so window_start < to + 1 hour
    return (reports.aggregated_metrics(_dates(m, frm, to, hi_shift="1 HOUR"))
            .filter(time_filter("hour", frm, to))
            .select(F.col("hour").alias("time"), "total_events", "total_stars",
                    "total_forks", "total_prs", "total_issues")
            .orderBy("time"))


def repository_stars(m: DataFrame, frm, to) -> DataFrame:
    """Stars per repository and window end, strictly inside the range."""
    # window_end > frm means window_start > frm - (window size); one day
    # covers every width the tables hold (hourly sliding, daily rollups)
    return (_dates(m, frm, to, lo_shift="1 DAY").filter(strictly_between("window_end", frm, to))
             .select("repo_name", F.col("window_end").alias("time"), "stars")
             .orderBy("time", "repo_name"))
