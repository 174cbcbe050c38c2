"""Raw-event projection and the four sliding-window metric tables.

Each function takes parsed (and, for languages, enriched) events and works
unchanged on a batch DataFrame and on a streaming one: on a stream, put
``withWatermark("created_at", ...)`` before calling, and the result is
emitted in append mode once a window closes.

Plan shape: ``window()`` with size/slide expands every event into
size/slide rows (4 for 1 h / 15 min) *inside* the scan stage, and the partial
aggregate right after it combines them map-side, so only one row per
(key, window) and task crosses the shuffle — a hot repository or user costs
one row per task, not one row per event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import WINDOW_SIZE, WINDOW_SLIDE


def event_window(size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE) -> Column:
    if size == slide:
        return F.window("created_at", size)
    return F.window("created_at", size, slide)


def flatten_window(df: DataFrame, name: str = "window") -> DataFrame:
    """``window`` struct -> ``window_start`` / ``window_end`` columns, placed
    after the entity keys."""
    cols = [c for c in df.columns if c != name]
    keys = [F.col(c) for c in cols if c in _LEADING]
    rest = [F.col(c) for c in cols if c not in _LEADING]
    return df.select(*keys, F.col(f"{name}.start").alias("window_start"),
                     F.col(f"{name}.end").alias("window_end"), *rest)


_LEADING = ("repo_id", "repo_name", "event_type", "user_id", "username", "language")


def raw_events(df: DataFrame, *more: str) -> DataFrame:
    """The flat raw-event table (one row per event), with ``more`` of its columns."""
    return df.select(
        "id", "type",
        F.col("actor.id").alias("actor_id"),
        F.col("actor.login").alias("actor_login"),
        F.col("repo.id").alias("repo_id"),
        F.col("repo.name").alias("repo_name"),
        "created_at", "collected_at", "processed_at", "public", *more,
    )


def stored_events(df: DataFrame) -> DataFrame:
    """The raw-event table as the lake stores it: with the languages, so that
    every metric table can be rebuilt from it."""
    return raw_events(df, "languages")


def from_stored(raw: DataFrame) -> DataFrame:
    """Stored raw events in the shape that the metric tables read."""
    return raw.select(
        "id", "type", F.struct(F.col("actor_id").alias("id"),
                               F.col("actor_login").alias("login")).alias("actor"),
        F.struct(F.col("repo_id").alias("id"), F.col("repo_name").alias("name")).alias("repo"),
        "created_at", F.coalesce("languages", F.array().cast("array<string>")).alias("languages"))


def _count_type(name: str) -> Column:
    return F.count_if(F.col("type") == name)


def repository_metrics(df: DataFrame, size: str = WINDOW_SIZE,
                       slide: str = WINDOW_SLIDE) -> DataFrame:
    """Per repository (id, name) and window: events, stars, forks, PRs, issues."""
    out = (df.groupBy(F.col("repo.id").alias("repo_id"),
                      F.col("repo.name").alias("repo_name"),
                      event_window(size, slide).alias("window"))
             .agg(F.count(F.lit(1)).alias("event_count"),
                  _count_type("WatchEvent").alias("stars"),
                  _count_type("ForkEvent").alias("forks"),
                  _count_type("PullRequestEvent").alias("pull_requests"),
                  _count_type("IssuesEvent").alias("issues")))
    return flatten_window(out)


def event_type_distribution(df: DataFrame, size: str = WINDOW_SIZE,
                            slide: str = WINDOW_SLIDE) -> DataFrame:
    """Per event type and window: events."""
    out = (df.groupBy(F.col("type").alias("event_type"),
                      event_window(size, slide).alias("window"))
             .agg(F.count(F.lit(1)).alias("event_count")))
    return flatten_window(out)


def _type_list(pairs: Column) -> Column:
    """Sorted comma list of types, each repeated by its count."""
    return F.array_join(F.flatten(F.transform(
        F.array_sort(pairs),
        lambda p: F.array_repeat(p.getField("type"), p.getField("n").cast("int")))), ",")


def _type_counts_text(pairs: Column) -> Column:
    return F.array_join(F.transform(
        F.array_sort(pairs),
        lambda p: F.concat(p.getField("type"), F.lit(":"), p.getField("n").cast("string"))), ",")


def user_activity(df: DataFrame, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE,
                  event_types_form: str = "counts") -> DataFrame:
    """Per user (id, login) and window: events, distinct repositories, types.

    Exact and streaming-legal without ``count(DISTINCT)`` or ``collect_list``
    over raw rows. One grouping-sets aggregate counts events per
    (user, window, repo) and per (user, window, type) in a single pass and
    shuffle; the second aggregate per (user, window) then sums the repo-level
    counts, counts repo rows (= distinct non-null repo ids) and gathers the
    (type, count) pairs, whose number is bounded by the distinct types.

    ``event_types`` holds sorted ``Type:count`` pairs, whose size stays bounded
    however many events a user sends. ``event_types_form="list"`` spells them
    out, each type repeated by its count: as long as the user's events are many,
    for reports over ordinary users.
    """
    base = df.select(
        F.col("actor.id").alias("user_id"),
        F.col("actor.login").alias("username"),
        event_window(size, slide).alias("window"),
        F.col("repo.id").alias("repo_id"),
        F.col("type").alias("type"),
    )
    keys = ["user_id", "username", "window"]
    stage1 = (base.groupingSets([keys + ["repo_id"], keys + ["type"]],
                                *keys, "repo_id", "type")
                  .agg(F.count(F.lit(1)).alias("n"),
                       F.grouping("repo_id").alias("by_type")))
    by_repo = F.col("by_type") == 0
    stage2 = stage1.groupBy(*keys).agg(
        F.sum(F.when(by_repo, F.col("n"))).alias("event_count"),
        F.count(F.when(by_repo, F.col("repo_id"))).alias("repos_contributed"),
        F.collect_list(F.when(~by_repo, F.struct("type", "n"))).alias("type_counts"),
    )
    text = _type_list if event_types_form == "list" else _type_counts_text
    out = stage2.select(*keys, "event_count", "repos_contributed",
                        text(F.col("type_counts")).alias("event_types"))
    return flatten_window(out)


def language_trends(df: DataFrame, size: str = WINDOW_SIZE,
                    slide: str = WINDOW_SLIDE) -> DataFrame:
    """Per language and window: events (needs ``enrich``ed input).

    Events without languages produce no row.
    """
    out = (df.select(F.explode("languages").alias("language"),
                     event_window(size, slide).alias("window"))
             .groupBy("language", "window")
             .agg(F.count(F.lit(1)).alias("event_count")))
    return flatten_window(out)


METRIC_TABLES = {
    "repository_metrics": repository_metrics,
    "event_type_distribution": event_type_distribution,
    "user_activity": user_activity,
    "language_trends": language_trends,
}
