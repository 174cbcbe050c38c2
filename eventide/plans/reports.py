"""Summary reports over the metric tables (V1-V5).

All take a metric-table DataFrame (computed, or read from the lake with
``sources.metric_table`` so the ``window_start`` predicate prunes date
partitions) and return a DataFrame.

Overlap. A sliding 1 h / 15 min window puts every event into four windows,
so summing ``event_count`` over windows counts each event four times.
``overlap="sum"`` keeps that (the published report definition);
``overlap="tile"`` first keeps only windows whose start is aligned to the
window size, i.e. non-overlapping hourly tiles, and gives true counts.

Top-k reports sort by the measure and then by the entity key, so ties at the
cut are decided the same way every time; ``orderBy().limit(k)`` plans as a
per-partition top-k plus a k-row merge (no global sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefilters import aligned_to, hours_before, since
from ..schema import WINDOW_SIZE


def _overlap(m: DataFrame, overlap: str, size: str = WINDOW_SIZE) -> DataFrame:
    if overlap == "sum":
        return m
    if overlap == "tile":
        return m.filter(aligned_to("window_start", size))
    raise ValueError(f"overlap must be 'sum' or 'tile', not {overlap!r}")


def _recent(m: DataFrame, as_of, hours: int) -> DataFrame:
    out = m.filter(since("window_start", as_of, hours))
    if "window_date" in m.columns:  # lake layout: prune whole date partitions
        out = out.filter(F.col("window_date") >= F.to_date(hours_before(as_of, hours)))
    return out


def _sum(c: str, alias: str):
    return F.sum(F.coalesce(F.col(c), F.lit(0))).cast("bigint").alias(alias)


def aggregated_metrics(m: DataFrame, overlap: str = "sum") -> DataFrame:
    """Per hour of ``window_start``: totals and distinct repositories, newest first."""
    return (_overlap(m, overlap)
            .groupBy(F.date_trunc("hour", F.col("window_start")).alias("hour"))
            .agg(_sum("event_count", "total_events"),
                 F.count_distinct("repo_id").alias("unique_repos"),
                 _sum("stars", "total_stars"),
                 _sum("forks", "total_forks"),
                 _sum("pull_requests", "total_prs"),
                 _sum("issues", "total_issues"))
            .orderBy(F.col("hour").desc()))


def top_repositories(m: DataFrame, as_of=None, k: int = 100, hours: int = 24,
                     overlap: str = "sum") -> DataFrame:
    return (_recent(_overlap(m, overlap), as_of, hours)
            .groupBy("repo_id", "repo_name")
            .agg(_sum("event_count", "total_events"),
                 _sum("stars", "total_stars"),
                 _sum("forks", "total_forks"),
                 _sum("pull_requests", "total_prs"),
                 _sum("issues", "total_issues"))
            .orderBy(F.col("total_events").desc(), "repo_id", "repo_name")
            .limit(k))


def top_users(u: DataFrame, as_of=None, k: int = 100, hours: int = 24,
              overlap: str = "sum") -> DataFrame:
    """``total_repos_contributed`` sums per-window distinct counts (it is not a
    distinct count over the whole range)."""
    return (_recent(_overlap(u, overlap), as_of, hours)
            .groupBy("user_id", "username")
            .agg(_sum("event_count", "total_events"),
                 _sum("repos_contributed", "total_repos_contributed"))
            .orderBy(F.col("total_events").desc(), "user_id", "username")
            .limit(k))


def top_languages(lt: DataFrame, as_of=None, k: int = 20, hours: int = 24,
                  overlap: str = "sum") -> DataFrame:
    return (_recent(_overlap(lt, overlap), as_of, hours)
            .groupBy("language")
            .agg(_sum("event_count", "total_events"))
            .orderBy(F.col("total_events").desc(), "language")
            .limit(k))


def with_share(df: DataFrame, measure: str, alias: str = "percentage") -> DataFrame:
    """Share of the grand total in percent, 2 decimals.

    The input is already grouped by a low-cardinality key (event types), so
    the empty-partition window collects only that many rows in one task.
    """
    total = F.sum(F.col(measure)).over(Window.partitionBy())
    pct = F.round(F.lit(100.0).cast("decimal(4,1)") * F.col(measure) / total, 2)
    return df.withColumn(alias, pct.cast("double"))


def event_type_summary(e: DataFrame, as_of=None, hours: int = 24,
                       overlap: str = "sum") -> DataFrame:
    grouped = (_recent(_overlap(e, overlap), as_of, hours)
               .groupBy("event_type")
               .agg(_sum("event_count", "total_events")))
    return with_share(grouped, "total_events").orderBy(
        F.col("total_events").desc(), "event_type")
