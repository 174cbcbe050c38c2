"""Rankings, moving frames and rollups over tumbling periods (W2, §2.4).

All work starts from hourly counts, which leave the scan pre-aggregated. Ranks
come from a histogram of counts per hour, so that an hour with very many
repositories is no single window; moving frames are cut into spans of time, so
that no repository's history is one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefilters import width_micros
from .temporal import slot

GRAINS = ("hour", "day", "month")
ALL = "(all)"


def hourly_counts(df: DataFrame) -> DataFrame:
    """Events per repository and hour."""
    return (df.groupBy(F.col("repo.id").alias("repo_id"), F.col("repo.name").alias("repo_name"),
                       F.date_trunc("hour", "created_at").alias("hour"))
            .agg(F.count(F.lit(1)).alias("event_count")))


def ranked(counts: DataFrame, group: str, measure: str, name: str = "rank") -> DataFrame:
    """Competition rank (equal values share it, gaps follow) by ``measure``, greatest
    first, in each ``group``: one more than the rows with a greater value.

    Only the group's histogram (a row per distinct value) is sorted; its running
    sums come back to the rows by a join on (group, value).
    """
    above = (Window.partitionBy(group).orderBy(F.desc(measure))
             .rowsBetween(Window.unboundedPreceding, -1))
    places = (counts.groupBy(group, measure).agg(F.count(F.lit(1)).alias("_n"))
              .select(group, measure, (F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1)
                      .cast("long").alias(name)))
    return counts.join(places, [group, measure]).select(*counts.columns, name)


def framed(counts: DataFrame, keys: list[str], time: str, frame: str, columns: dict[str, Column],
           span: str = "7 days") -> DataFrame:
    """Adds ``columns``, aggregates of a moving frame: the rows of the same keys from
    ``frame`` before a row (excluded) up to it.

    Rows are dealt by (keys, span of time); those in the last ``frame`` of a span go
    to the next one, too, where they are only looked at. A span is a few weeks of
    one key at most, however long the key's history is.
    """
    size, reach = width_micros(span), width_micros(frame)
    if size < reach:
        raise ValueError("a span must be as long as the frame")
    here = slot(F.col(time), size)
    ahead = F.when(F.unix_micros(time) + reach > here + size, here + size)
    rows = counts.select("*", here.alias("_home"), F.explode(F.array_compact(
        F.array(here, ahead))).alias("_span"))
    window = (Window.partitionBy(*keys, "_span").orderBy(F.unix_micros(time))
              .rangeBetween(-reach + 1, Window.currentRow))
    return (rows.select("*", *[c.over(window).alias(n) for n, c in columns.items()])
            .where(F.col("_home") == F.col("_span")).drop("_home", "_span"))


def repository_trend(df: DataFrame, span: str = "7 days") -> DataFrame:
    """Per repository and hour with events: the count, its rank in the hour, the
    change against the hour before (0 events where the repository has no row) and
    the sum of the 24 hours that end with this one."""
    hourly = ranked(hourly_counts(df), "hour", "event_count")
    out = framed(hourly, ["repo_id", "repo_name"], "hour", "24 hours", {
        "moving_24h": F.sum("event_count"),
        "_near": F.collect_list(F.struct("hour", "event_count"))}, span)     # at most 24 rows
    before = F.filter("_near", lambda x: x.getField("hour")
                      == F.col("hour") - F.expr("INTERVAL 1 HOUR"))
    return out.select(
        "repo_id", "repo_name", "hour", "event_count", "rank",
        (F.col("event_count") - F.coalesce(F.try_element_at(before, F.lit(1)).getField("event_count"),
                                           F.lit(0))).alias("change"), "moving_24h")


def type_language_rollup(df: DataFrame) -> DataFrame:
    """Events by hour, day and month, by type and language, with the totals over
    types and over languages (``(all)``), in one pass.

    The events are counted per hour, type and language once (with one more row for
    "all languages", as an event may name several); one expansion with partial
    aggregation then makes every grain and total of these few rows.
    """
    hourly = (df.select(F.date_trunc("hour", "created_at").alias("period"),
                        F.col("type").alias("event_type"),
                        F.explode(F.array_distinct(F.concat(F.array(F.lit(ALL)), F.coalesce(
                            "languages", F.array().cast("array<string>"))))).alias("language"))
              .groupBy("period", "event_type", "language").agg(F.count(F.lit(1)).alias("n")))
    wide = hourly.select("event_type", "language", "n", *[
        F.date_trunc(g, "period").alias(g) for g in GRAINS])
    sets = [[g, *types, "language"] for g in GRAINS for types in (["event_type"], [])]
    rolled = (wide.groupingSets(sets, *GRAINS, "event_type", "language")
              .agg(F.sum("n").alias("event_count"), F.grouping("event_type").alias("_all"),
                   *[F.grouping(g).alias(f"_{g}") for g in GRAINS]))
    grain = F.coalesce(*[F.when(F.col(f"_{g}") == 0, F.lit(g)) for g in GRAINS])
    return rolled.select(
        grain.alias("grain"), F.coalesce(*GRAINS).alias("period"),
        F.when(F.col("_all") == 1, F.lit(ALL)).otherwise(F.col("event_type")).alias("event_type"),
        "language", "event_count")
