"""Named queries over a directory of driver tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each builds one plan from the Parquet scan of ``events`` through the ingest
path (land -> parse -> validate -> dedup -> enrich) to its result; output
timestamps are ``timestamp_ntz`` (UTC wall clock).
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import lake
from ..config import scratch_dir
from ..functions.parse import parse_events
from ..functions.timefilters import days_before, hours_before, resolve_range, ts_lit
from ..operators import (compare, distinct, maintenance, metrics, quality, sessions, temporal,
                         trends)
from ..sources.adapter import landed_records
from ..sources.events import event_stream, metric_table
from ..sources.landing import land_in_time_order, landed_files
from ..streaming import heavy, runner, sinks
from . import panels, repair, reports, tables, views
from .pipeline import (AS_OF, KEYED_APPEND_CUT, PANEL_FROM, PANEL_TO, RETENTION_AS_OF,
                       events, ntz, parsed, table)

Query = Callable[[SparkSession, str], DataFrame]


# --- ingest and quality ------------------------------------------------------

def q_parse_events(spark, sf):
    return ntz(parsed(spark, sf, payload="map").select(
        "event_key", "id", "type",
        F.col("actor.id").alias("actor_id"), F.col("actor.login").alias("actor_login"),
        F.col("actor.url").alias("actor_url"),
        F.col("repo.id").alias("repo_id"), F.col("repo.name").alias("repo_name"),
        F.col("repo.url").alias("repo_url"), "public", "created_at", "collected_at",
        F.array_join(F.array_sort(F.map_keys("payload")), ",").alias("payload_keys")))


def q_raw_events(spark, sf):
    return ntz(metrics.raw_events(events(spark, sf)))


def _valid_rejected(spark, sf):
    return quality.validate(parsed(spark, sf, defects=True))


def q_validate_valid(spark, sf):
    return ntz(metrics.raw_events(_valid_rejected(spark, sf)[0]))


def q_validate_rejected(spark, sf):
    return _valid_rejected(spark, sf)[1]


def q_unknown_types(spark, sf):
    return quality.unknown_type_counts(_valid_rejected(spark, sf)[0])


def q_dedup_events(spark, sf):
    valid, _ = quality.validate(parsed(spark, sf, replays=True))
    return ntz(metrics.raw_events(quality.dedup(valid)))


def q_enrich_languages(spark, sf):
    return events(spark, sf).select(
        "id", "type", F.array_join("languages", ",").alias("languages"),
        F.size("languages").alias("n_languages"))


def _metric_cols():
    rm = F.col("repository_metrics")
    return [rm.getField(c).alias(c) for c in
            ("repo_id", "repo_name", "stars", "forks", "watchers", "open_issues")]


def q_enrich_repo_metrics(spark, sf):
    return events(spark, sf).select("id", "type", *_metric_cols())


def q_enrich(spark, sf):
    return events(spark, sf).select(
        "id", "type", F.array_join("languages", ",").alias("languages"), *_metric_cols())


# --- metric tables -------------------------------------------------------------

def _metric(name: str, **kw) -> Query:
    def q(spark, sf):
        return ntz(metrics.METRIC_TABLES[name](events(spark, sf), **kw))
    q.__name__ = f"q_{name}"
    return q


# Reports over a time range read the events that can lie in its windows only:
# ``created_at`` from the first window's start to the last window's end.

def _rm(spark, sf, since=None, before=None):
    return metrics.repository_metrics(events(spark, sf, since=since, before=before))


def _et(spark, sf, since=None, before=None):
    return metrics.event_type_distribution(events(spark, sf, since=since, before=before))


def _ua(spark, sf, since=None, before=None):
    return metrics.user_activity(events(spark, sf, since=since, before=before))


def _lt(spark, sf, since=None, before=None):
    return metrics.language_trends(events(spark, sf, since=since, before=before))


def _day():
    """Lower bound of the trailing-24 h reports."""
    return hours_before(AS_OF, 24)


def _plus(ts: str, hours: int):
    return ts_lit(ts) + F.make_interval(hours=F.lit(hours))


def _stored(spark, df: DataFrame, owner: str) -> DataFrame:
    """``df`` computed once into the shared folder and read back: for queries
    that use it more than once."""
    path = scratch_dir(spark, owner)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _activity(spark, sf):
    m = _stored(spark, _rm(spark, sf, since=F.least(ts_lit(PANEL_FROM), _day())), "activity")
    return panels.repository_activity(m, PANEL_FROM, PANEL_TO, AS_OF)


WEEK = resolve_range("now-7d", dt.datetime.fromisoformat(AS_OF))


# --- reports and panels ----------------------------------------------------------

QUERIES: dict[str, Query] = {
    "parse_events": q_parse_events,
    "raw_events": q_raw_events,
    "validate_valid": q_validate_valid,
    "validate_rejected": q_validate_rejected,
    "unknown_types": q_unknown_types,
    "dedup_events": q_dedup_events,
    "enrich_languages": q_enrich_languages,
    "enrich_repo_metrics": q_enrich_repo_metrics,
    "enrich": q_enrich,
    "repository_metrics": _metric("repository_metrics"),
    "event_type_distribution": _metric("event_type_distribution"),
    "user_activity": _metric("user_activity", event_types_form="list"),
    "user_activity_counts": _metric("user_activity"),
    "language_trends": _metric("language_trends"),
    "aggregated_metrics": lambda s, d: ntz(reports.aggregated_metrics(_rm(s, d))),
    "top_repositories": lambda s, d: ntz(reports.top_repositories(_rm(s, d, _day()), AS_OF)),
    "top_repositories_tiled": lambda s, d: ntz(
        reports.top_repositories(_rm(s, d, _day()), AS_OF, overlap="tile")),
    "top_users": lambda s, d: ntz(reports.top_users(_ua(s, d, _day()), AS_OF)),
    "top_languages": lambda s, d: ntz(reports.top_languages(_lt(s, d, _day()), AS_OF)),
    "event_type_summary": lambda s, d: ntz(
        reports.event_type_summary(_et(s, d, _day()), AS_OF)),
    "panel_repository_activity": lambda s, d: ntz(_activity(s, d)),
    "panel_series_stats": lambda s, d: panels.series_stats(_activity(s, d)),
    "panel_event_types": lambda s, d: panels.event_types(
        _et(s, d, PANEL_FROM, _plus(PANEL_TO, 1)), PANEL_FROM, PANEL_TO),
    "panel_event_types_7d": lambda s, d: panels.event_types(
        _et(s, d, WEEK[0], _plus(AS_OF, 1)), *WEEK),
    "panel_top_languages": lambda s, d: panels.top_languages(
        _lt(s, d, PANEL_FROM, _plus(PANEL_TO, 1)), PANEL_FROM, PANEL_TO),
    "panel_top_repositories": lambda s, d: panels.top_repositories(_rm(s, d, _day()), AS_OF),
    "panel_top_users": lambda s, d: panels.top_users(_ua(s, d, _day()), AS_OF),
    "panel_overall_trends": lambda s, d: ntz(panels.overall_trends(
        _rm(s, d, PANEL_FROM, _plus(PANEL_TO, 2)), PANEL_FROM, PANEL_TO)),
    "panel_repository_stars": lambda s, d: ntz(panels.repository_stars(
        _rm(s, d, _plus(PANEL_FROM, -1), PANEL_TO), PANEL_FROM, PANEL_TO)),
}


# --- maintenance and sinks ---------------------------------------------------------

def q_flow_check(spark, sf):
    return ntz(maintenance.flow_check(events(spark, sf)))


def q_retain_events(spark, sf):
    since = days_before(AS_OF, maintenance.RAW_EVENT_DAYS)
    return ntz(maintenance.retain(metrics.raw_events(events(spark, sf, since=since)),
                                  "created_at", maintenance.RAW_EVENT_DAYS, AS_OF))


def _counted_events(spark, sf, owner):
    """The columns that the repository table reads, stored once."""
    return _stored(spark, events(spark, sf).select("id", "type", "repo", "created_at"), owner)


def _hourly_daily(spark, sf):
    ev = _counted_events(spark, sf, "tiers")
    return metrics.repository_metrics(ev), metrics.repository_metrics(ev, "1 day", "1 day")


def q_retain_tiered(spark, sf):
    hourly, daily = _hourly_daily(spark, sf)
    return ntz(maintenance.retain_tiered(hourly.unionByName(daily), as_of=RETENTION_AS_OF))


def q_arrays_to_text(spark, sf):
    ev = events(spark, sf)
    return sinks.arrays_to_text(ev.select(
        "id", "languages", F.array("type", F.col("repo.name")).alias("tags")))


def q_keyed_json(spark, sf):
    return sinks.to_keyed_json(events(spark, sf).select(
        "id", "type",
        F.col("actor.id").alias("actor_id"), F.col("actor.login").alias("actor_login"),
        F.col("repo.id").alias("repo_id"), F.col("repo.name").alias("repo_name"),
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("created_at"),
        "languages"), key_col="repo_name")


def q_keyed_append(spark, sf):
    """A metric batch appended to a table that already holds the first half of
    the month: rows whose key exists are skipped (insert-if-absent)."""
    ev = _counted_events(spark, sf, "append")
    target = metrics.repository_metrics(ev.filter(F.col("created_at") < ts_lit(KEYED_APPEND_CUT)))
    batch = metrics.repository_metrics(ev)
    key = list(sinks.TABLE_KEYS["repository_metrics"])
    return ntz(target.unionByName(sinks.keyed_append(batch, target, key)))


QUERIES.update({
    "flow_check": q_flow_check,
    "retain_events": q_retain_events,
    "retain_tiered": q_retain_tiered,
    "arrays_to_text": q_arrays_to_text,
    "keyed_json": q_keyed_json,
    "keyed_append": q_keyed_append,
})

# --- end-to-end paths through written tables ----------------------------------

STREAM_WATERMARK = "10 minutes"
STREAM_FILES = 6                       # time ranges: one micro-batch each
ROWS_PER_LANDED_FILE = 100_000         # a file is written and parsed by one task


def _land_records(spark, records: DataFrame, at: str, root: str) -> str:
    """Records as files in the order of ``at``: ``STREAM_FILES``, or a multiple of
    it where they are many."""
    each = -(-records.count() // (STREAM_FILES * ROWS_PER_LANDED_FILE))
    land = os.path.join(root, "landing")
    land_in_time_order(spark, records, at, land, STREAM_FILES * max(1, each))
    return land


def _land(spark, sf, root: str, before: str | None = None) -> str:
    ev = table(spark, sf, "events")
    if before:
        ev = ev.filter(F.col("ts") < F.lit(before).cast("timestamp_ntz"))
    return _land_records(spark, landed_records(ev, keep=("ts",)), "ts", root)


def _land_late(spark, sf, root: str, **kw) -> str:
    """Records in an order in which some come up to three days late."""
    recs = landed_records(table(spark, sf, "events"), keep=("ts",), **kw)
    late = F.make_dt_interval(days=F.pmod(F.xxhash64("value"), F.lit(4)).cast("int"))
    return _land_records(spark, recs.withColumn("sent", F.col("ts") + late), "sent", root)


def _landing_stream(spark, land: str) -> DataFrame:
    """The landed records, a time range per micro-batch."""
    each = -(-len(landed_files(spark, land)) // STREAM_FILES)
    return event_stream(spark, "parquet", land, maxFilesPerTrigger=max(1, each))


def _drain(spark, land: str, root: str, tables_: list[str], **kw) -> str:
    lake_root = os.path.join(root, "lake")
    qs = runner.run_all(spark, _landing_stream(spark, land), lake_root,
                        os.path.join(root, "ckpt"), trigger={"availableNow": True},
                        watermark=STREAM_WATERMARK, tables=tables_, with_rejected=False, **kw)
    runner.await_all(spark, qs, bounded=True)
    return lake_root


def _served(spark, lake_root: str, name: str) -> DataFrame:
    return ntz(metric_table(spark, lake_root, name).drop(*lake.LAYOUT.names))


def q_stream_repository_metrics(spark, sf):
    """The repository table as the streaming job produces it.

    The events are landed as files in event-time order, then drained by the
    streaming job: the ingest query (parse, validation, enrichment -> clean
    Parquet table) and the repository query streaming from it (append mode).
    Append mode emits only closed windows: those ending at or before the final
    watermark (latest event time minus the delay).
    """
    root = scratch_dir(spark, "stream")
    lake_root = _drain(spark, _land(spark, sf, root), root, ["repository_metrics"])
    return _served(spark, lake_root, "repository_metrics")


def q_stream_repository_metrics_update(spark, sf):
    """The same in update mode: open windows are upserted too, so no window of
    a drained backlog is missing."""
    root = scratch_dir(spark, "stream")
    lake_root = _drain(spark, _land(spark, sf, root), root, ["repository_metrics"],
                       mode="update")
    return _served(spark, lake_root, "repository_metrics")


def q_stream_raw_events(spark, sf):
    """The raw table of a stream that holds replayed records and records up to
    three days late: every event once."""
    root = scratch_dir(spark, "stream")
    lake_root = _drain(spark, _land_late(spark, sf, root, replays=True), root, ["events"])
    return _served(spark, lake_root, "events").select("id", "repo_id", "repo_name", "created_at")


def q_stream_then_build(spark, sf):
    """Half the month streamed, then everything built into the same lake."""
    root = scratch_dir(spark, "stream")
    land = _land(spark, sf, root, before=KEYED_APPEND_CUT)
    lake_root = _drain(spark, land, root, ["events", "repository_metrics"])
    tables.build_tables(spark, events(spark, sf), lake_root, ["events", "repository_metrics"])
    return _served(spark, lake_root, "repository_metrics")


def q_lake_top_repositories(spark, sf):
    """Top repositories read back from the batch-built lake tables (the
    ``window_start`` range also prunes ``window_date`` partitions)."""
    root = scratch_dir(spark, "lake")
    tables.build_tables(spark, events(spark, sf), root, ["repository_metrics"])
    return ntz(reports.top_repositories(metric_table(spark, root, "repository_metrics"), AS_OF))


def q_view_event_type_summary(spark, sf):
    """A report selected by name from a lake's registered relations; all of
    the served tables are built, from all events."""
    root = scratch_dir(spark, "lake")
    tables.build_tables(spark, events(spark, sf), root)
    views.register(spark, root, AS_OF, prefix="served_")
    return ntz(spark.sql("SELECT * FROM served_event_type_summary"))


def q_lake_retain(spark, sf):
    """Raw events written, expired on disk after 7 days, read back."""
    root = scratch_dir(spark, "lake")
    tables.build_tables(spark, events(spark, sf), root, ["events"])
    path = os.path.join(root, "events")
    as_of = dt.date.fromisoformat(AS_OF[:10])
    lake.expire(spark, path, "events",
                F.col("created_at") < days_before(AS_OF, maintenance.RAW_EVENT_DAYS),
                as_of - dt.timedelta(days=maintenance.RAW_EVENT_DAYS))
    return _served(spark, root, "events")


def q_lake_retain_tiered(spark, sf):
    """Hourly and daily metric rows written to one table, expired on disk by
    their own tiers, read back."""
    root = scratch_dir(spark, "lake")
    path = os.path.join(root, "repository_metrics")
    hourly, daily = _hourly_daily(spark, sf)
    lake.append(hourly, path, "repository_metrics", "hourly")
    lake.append(daily, path, "repository_metrics", "daily")
    as_of = dt.date.fromisoformat(RETENTION_AS_OF[:10])
    lake.expire(spark, path, "repository_metrics",
                maintenance.tier_expired(as_of=RETENTION_AS_OF),
                as_of - dt.timedelta(days=min(maintenance.DEFAULT_TIERS.values())))
    return _served(spark, root, "repository_metrics")


QUERIES.update({f.__name__[2:]: f for f in (
    q_stream_repository_metrics, q_stream_repository_metrics_update, q_stream_raw_events,
    q_stream_then_build, q_lake_top_repositories, q_view_event_type_summary, q_lake_retain,
    q_lake_retain_tiered)})

# --- sessions, joins by time, trends -----------------------------------------------

def q_session_activity(spark, sf):
    return ntz(sessions.session_activity(events(spark, sf)))


def q_push_then_star(spark, sf):
    return ntz(temporal.push_then_star(_seen(spark, sf, "followed")))


def _seen(spark, sf, owner):
    """Types, repositories and times of the events, stored once for both sides."""
    return _stored(spark, events(spark, sf).select("id", "type", "repo", "created_at",
                                                   "repository_metrics"), owner)


def q_asof_repository_counters(spark, sf):
    """Every star with the repository's last reported counters before it."""
    ev = _seen(spark, sf, "asof").select("id", "type", F.col("repo.id").alias("repo_id"),
                                         "created_at", "repository_metrics")
    reports_ = ev.where(F.col("type").isin("IssuesEvent", "PullRequestEvent")).select(
        "repo_id", F.col("created_at").alias("reported_at"), F.col("id").alias("report_id"),
        *[F.col(f"repository_metrics.{c}").alias(c) for c in ("stars", "forks", "open_issues")]
    ).where("stars IS NOT NULL")
    stars = ev.where("type = 'WatchEvent'").select("id", "repo_id", "created_at")
    return ntz(temporal.as_of_join(stars, reports_, ["repo_id"], "created_at", "reported_at",
                                   ["stars", "forks", "open_issues"], tie="report_id"))


def q_events_in_incidents(spark, sf):
    """Events inside incidents ``[from, to)``: some issues open one each, which lasts
    from ten minutes to over five hours."""
    ev = _seen(spark, sf, "incidents").select("id", "type", F.col("repo.id").alias("repo_id"),
                                              "created_at")
    minutes = 10 + F.col("repo_id") % 7 * 50
    incidents = ev.where("type = 'IssuesEvent' AND repo_id % 20 = 3").select(
        F.col("id").alias("incident_id"), F.col("created_at").alias("began_at"),
        (F.col("created_at") + F.make_interval(mins=minutes.cast("int"))).alias("ended_at"))
    hits = temporal.interval_join(ev, incidents, "created_at", "began_at", "ended_at")
    return ntz(hits.select("incident_id", "id", "type", "repo_id", "created_at"))


def q_user_distinct_repositories(spark, sf):
    return distinct.exact_repositories(events(spark, sf))


def q_user_sketched_repositories(spark, sf):
    """Hourly sketches built into a lake, united at read: whether each user's
    estimate is within the stated error of the exact number."""
    root = scratch_dir(spark, "sketches")
    ev = events(spark, sf)
    tables.build_tables(spark, ev, root, ["user_repositories"])
    about = distinct.sketched_repositories(metric_table(spark, root, "user_repositories"))
    about = about.withColumnRenamed("distinct_repos", "about")
    exact = distinct.exact_repositories(ev)
    return (about.drop("total_events").join(exact, list(distinct.USER)).select(
        *distinct.USER, "total_events", (F.abs(F.col("about") - F.col("distinct_repos"))
                                         <= 0.5 + distinct.SKETCH_ERROR * F.col("distinct_repos"))
        .alias("within_error")))


def q_repository_trend(spark, sf):
    return ntz(trends.repository_trend(events(spark, sf)))


def q_type_language_rollup(spark, sf):
    return ntz(trends.type_language_rollup(events(spark, sf)))


def q_stream_sessions(spark, sf):
    """Sessions as the streaming job serves them: those that the final watermark
    has closed."""
    root = scratch_dir(spark, "stream")
    lake_root = _drain(spark, _land(spark, sf, root), root, ["session_activity"])
    return _served(spark, lake_root, "session_activity")


def q_stream_push_then_star(spark, sf):
    """The same pairs as two joined streams, with the pushes that got no star in
    their hour, once each."""
    root = scratch_dir(spark, "stream")
    lake_root = _drain(spark, _land(spark, sf, root), root, ["push_then_star"])
    return _served(spark, lake_root, "push_then_star")


# --- builds in parts, comparison, repair -------------------------------------------

def _all_served(spark, lake_root: str) -> DataFrame:
    """One row per row of every served table: its table, entity, time and count."""
    def rows(name: str, entity: str, time: str, n: str) -> DataFrame:
        return metric_table(spark, lake_root, name).select(
            F.lit(name).alias("table_name"), F.expr(entity).cast("string").alias("entity"),
            F.expr(time).cast("timestamp_ntz").alias("at"), F.expr(n).cast("long").alias("n"))
    return (rows("events", "id", "created_at", "1")
            .unionByName(rows("repository_metrics", "repo_name", "window_start", "event_count"))
            .unionByName(rows("event_type_distribution", "event_type", "window_start", "event_count"))
            .unionByName(rows("user_activity", "username", "window_start",
                              "event_count * 1000 + repos_contributed"))
            .unionByName(rows("language_trends", "language", "window_start", "event_count"))
            .unionByName(rows("rejected_events", "errors", "TIMESTAMP_NTZ '2024-01-01 00:00:00'", "1")
                         .groupBy("table_name", "entity", "at").agg(F.sum("n").alias("n"))))


def q_build_in_parts(spark, sf):
    """The month built in unequal, overlapping parts (half of all ids, the first
    half, the second), one of them twice, with the rejected records each time."""
    root = scratch_dir(spark, "parts")
    ev = _stored(spark, events(spark, sf).select(
        "id", "type", "actor", "repo", "created_at", "collected_at", "processed_at", "public",
        "languages"), "parts")
    bad = _stored(spark, quality.rejected_records(parsed(spark, sf, defects=True)), "parts")
    first = ev.where(F.col("created_at") < ts_lit("2024-01-16 12:00:00"))
    for part in (ev.where("id % 2 = 0"), first, ev.where(
            F.col("created_at") >= ts_lit("2024-01-12 07:30:00")), first):
        tables.build_tables(spark, part, root, rejected=bad)
    return _all_served(spark, root)


def q_compare_lakes(spark, sf):
    """A streamed lake's raw table against a built one in which some events are
    missing and some have another type."""
    streamed, built = scratch_dir(spark, "stream"), scratch_dir(spark, "built")
    _drain(spark, _land(spark, sf, streamed), streamed, ["events"])
    ev = events(spark, sf).where("id % 487 <> 3").withColumn(
        "type", F.when(F.expr("id % 499 = 5"), F.lit("GollumEvent")).otherwise(F.col("type")))
    tables.build_tables(spark, ev, built, ["events"])
    cols = ["id", "type", "actor_id", "repo_id", "created_at"]
    return ntz(compare.differences(
        metric_table(spark, os.path.join(streamed, "lake"), "events"),
        metric_table(spark, built, "events"), F.col("window_date"), cols))


def q_stream_enriched_events(spark, sf):
    """The enriched stream as published: keyed JSON records, read back."""
    root = scratch_dir(spark, "stream")
    lake_root = _drain(spark, _land(spark, sf, root), root, ["enriched_events"], sink="json")
    said = spark.read.parquet(os.path.join(lake_root, "_json", "enriched_events"))
    value = F.from_json("value", "id string, type string, actor_id long, actor_login string, "
                                 "repo_id long, created_at timestamp, languages array<string>")
    return ntz(said.select("key", value.alias("v")).select("key", "v.*").withColumn(
        "languages", F.array_join("languages", ",")))


def q_stream_repair(spark, sf):
    """A stream whose records come up to three days late: windows that closed
    without them are marked and recomputed."""
    root = scratch_dir(spark, "stream")
    lake_root = _drain(spark, _land_late(spark, sf, root), root,
                       ["events", "repository_metrics"], mode="update", staged=False, marks=True)
    repair.repair(spark, lake_root, ["repository_metrics"], ended=True)
    return _served(spark, lake_root, "repository_metrics")


HEAVY_SHARE = 0.013


def q_stream_heavy_hitters(spark, sf):
    """Repositories with a share of a day's events, from bounded summaries of the
    stream: whether every count lies within the summaries' bounds."""
    heavy.needs(spark)
    root = scratch_dir(spark, "stream")
    records = _landing_stream(spark, _land(spark, sf, root))
    valid = quality.validate(parse_events(records))[0]
    found, ckpt = os.path.join(root, "summaries"), os.path.join(root, "ckpt")
    q = (heavy.summaries(valid.withWatermark("created_at", STREAM_WATERMARK)).writeStream
         .outputMode("append").option("checkpointLocation", ckpt).format("parquet")
         .option("path", found).trigger(availableNow=True).start())
    q.awaitTermination()
    stored = spark.read.schema(heavy.SUMMARY).parquet(found)
    about = heavy.heavy(stored, HEAVY_SHARE)
    exact = (_seen(spark, sf, "heavy").groupBy(
        F.date_trunc("day", "created_at").alias("window_start"), F.col("repo.id").alias("repo_id"))
        .agg(F.count(F.lit(1)).alias("event_count")))
    return ntz(exact.join(about, ["window_start", "repo_id"]).where(
        F.col("event_count") >= F.col("window_events") * HEAVY_SHARE).select(
        "window_start", "repo_id", "event_count", "window_events",
        F.col("event_count").between(F.col("at_least"), F.col("at_most")).alias("within_bounds")))


QUERIES.update({f.__name__[2:]: f for f in (
    q_session_activity, q_push_then_star, q_asof_repository_counters, q_events_in_incidents,
    q_user_distinct_repositories, q_user_sketched_repositories, q_repository_trend,
    q_type_language_rollup, q_stream_sessions, q_stream_push_then_star, q_build_in_parts,
    q_compare_lakes, q_stream_enriched_events, q_stream_repair, q_stream_heavy_hitters)})

FLAGSHIP = "top_repositories"
