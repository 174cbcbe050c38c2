"""Structured Streaming jobs: one named query per served table.

``run_all`` starts, each with its own name and checkpoint directory so a restart
resumes exactly where it stopped:

* ``clean_events`` (ingest): the only query that parses the JSON source. It is
  stateless and writes *every* record, valid or rejected, through Spark's
  exactly-once file sink (Parquet; each micro-batch's files hold a narrow time
  range, so statistics on ``created_at`` prune reads, and files expire by age:
  the sink's ``retention`` option plus ``sinks.expire_landed_files``);
* ``events``: the raw table, every valid event once however late it is (unique
  by id against the stored dates of the batch);
* the metric queries: watermark, de-duplication within it, windowed aggregate.
  ``append`` emits a window once the watermark passes its end, about ``size +
  delay`` after its first event; ``update`` upserts open windows by key at each
  trigger. Events older than the watermark are not in the metric tables
  (``numRowsDroppedByWatermark`` in the progress) but are in the raw table, from
  which ``plans.tables.build_tables`` rebuilds the dates concerned;
* ``rejected_events``: the validation report.

(``staged=False`` runs every table query straight off the source instead, which
parses the JSON once per query.)
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import stream_checkpoint
from ..functions.parse import parse_events
from ..operators import enrich as enrich_ops
from ..operators import distinct, metrics, quality, sessions, temporal
from ..schema import CLEAN_EVENT, KNOWN_EVENT_TYPES
from . import sinks
from .late import late_marker

DEFAULT_WATERMARK = "10 minutes"
EVENTS_VIEW = "activity_events"


def register(df: DataFrame, name: str = EVENTS_VIEW) -> DataFrame:
    """Expose a (streaming) DataFrame to SQL under ``name``."""
    df.createOrReplaceTempView(name)
    return df


def prepare(records: DataFrame, watermark: str = DEFAULT_WATERMARK,
            dedup: bool = True) -> tuple[DataFrame, DataFrame]:
    """Record stream -> ``(events, rejected)``.

    ``events`` carries the event-time watermark on ``created_at`` and its
    quality counters as observed metrics (``event_quality`` in the query
    progress: rows, unknown types).
    """
    parsed = parse_events(records)
    valid, rejected = quality.validate(parsed)
    ev = valid.withWatermark("created_at", watermark)
    if dedup:
        ev = quality.dedup_stream(ev)
    ev = enrich_ops.enrich(ev)
    ev = ev.observe("event_quality",
                    F.count(F.lit(1)).alias("events"),
                    F.count_if(~F.col("type").isin(*KNOWN_EVENT_TYPES)).alias("unknown_types"))
    return ev, rejected


def _trigger(writer, trigger: dict | None):
    if not trigger:
        return writer
    return writer.trigger(**trigger)


def start_query(df: DataFrame, name: str, sink: Callable[[DataFrame, int], None],
                checkpoint: str, mode: str = "append",
                trigger: dict | None = None) -> StreamingQuery:
    """Start one named streaming query writing through ``foreachBatch``.

    ``trigger`` is passed to ``DataStreamWriter.trigger``:
    ``{"availableNow": True}`` (drain what is there, then stop) or
    ``{"processingTime": "60 seconds"}``; default: as fast as possible.
    """
    w = (df.writeStream.queryName(name).outputMode(mode)
           .option("checkpointLocation", checkpoint).foreachBatch(sink))
    return _trigger(w, trigger).start()


TABLE_BUILDERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "events": metrics.raw_events,
    **metrics.METRIC_TABLES,
}


#: Further tables that a job serves where asked to; they are final when they are
#: emitted, so they are appended in either mode.
MORE_TABLES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "session_activity": sessions.session_activity,
    "push_then_star": lambda ev: temporal.push_then_star(ev, how="left_outer"),
    "user_repositories": distinct.user_repository_sketches,
}


def clean_columns(ev: DataFrame) -> DataFrame:
    """The clean-event columns the served tables read (``schema.CLEAN_EVENT``), of
    events with their list of ``errors``."""
    rejected = F.size("errors") > 0
    return ev.select(
        "id", "type",
        F.struct(F.col("actor.id").alias("id"), F.col("actor.login").alias("login")).alias("actor"),
        F.struct(F.col("repo.id").alias("id"), F.col("repo.name").alias("name")).alias("repo"),
        "created_at", "collected_at", "processed_at", "public",
        F.when(~rejected, F.col("languages")).alias("languages"),
        F.when(rejected, F.array_join("errors", ",")).alias("errors"),
        "event_key", F.when(rejected, F.col("record_id")).alias("record_id"))


def start_ingest(records: DataFrame, clean_path: str, checkpoint: str,
                 trigger: dict | None = None, retention: str | None = None) -> StreamingQuery:
    """Parse once: all events -> Parquet file sink (exactly-once via its metadata
    log; a downstream file source reads only committed files).

    Rejected records (non-empty ``errors``) travel in the same table, so their
    report needs no second parse of the source. ``retention`` (e.g. ``"7d"``)
    drops old entries from the sink's log so expired files can be deleted."""
    # one scan and one parse: valid and rejected records are told apart by a column
    ev = enrich_ops.enrich(parse_events(records).withColumn("errors", quality.error_list()))
    valid = F.size("errors") == 0
    out = clean_columns(ev.observe(
        "event_quality", F.count_if(valid).alias("events"),
        F.count_if(valid & ~F.col("type").isin(*KNOWN_EVENT_TYPES)).alias("unknown_types")))
    w = (out.writeStream.queryName("clean_events").outputMode("append")
         .format("parquet").option("path", clean_path)
         .option("checkpointLocation", checkpoint))
    if retention:
        w = w.option("retention", retention)
    return _trigger(w, trigger).start()


def clean_stream(spark: SparkSession, clean_path: str, **options) -> DataFrame:
    """The valid events of the clean table as a stream."""
    return (spark.readStream.schema(CLEAN_EVENT).options(**options).parquet(clean_path)
            .filter(F.col("errors").isNull()).drop("errors"))


def watermarked(ev: DataFrame, watermark: str, dedup: bool = True) -> DataFrame:
    """Events in front of a windowed aggregate: watermark, copies removed."""
    ev = ev.withWatermark("created_at", watermark)
    return quality.dedup_stream(ev) if dedup else ev


def rejected_stream(spark: SparkSession, clean_path: str, **options) -> DataFrame:
    """The rejected records of the clean table: the validation report, dated
    by their ingest time."""
    return (spark.readStream.schema(CLEAN_EVENT).options(**options).parquet(clean_path)
            .filter(F.col("errors").isNotNull())
            .select(F.coalesce("id", F.lit("unknown")).alias("id"),
                    F.coalesce("type", F.lit("unknown")).alias("type"),
                    "errors", "event_key", "record_id", F.col("processed_at").alias("created_at")))


def _enriched(spark: SparkSession, ev: DataFrame) -> DataFrame:
    """The enriched event as published: flat keys, languages."""
    return ev.select("id", "type", F.col("actor.id").alias("actor_id"),
                     F.col("actor.login").alias("actor_login"), F.col("repo.id").alias("repo_id"),
                     F.col("repo.name").alias("repo_name"), "created_at", "languages")


def run_all(spark: SparkSession, records: DataFrame, lake_root: str,
            checkpoint_root: str | None = None, trigger: dict | None = None,
            watermark: str = DEFAULT_WATERMARK, tables: list[str] | None = None,
            dedup: bool = True, with_rejected: bool = True, staged: bool = True,
            sink: str = "lake", sink_options: dict | None = None, mode: str = "append",
            retention: str | None = None, marks: bool = False) -> list[StreamingQuery]:
    """Start the ingest query, one query per served table, and ``rejected_events``.

    ``sink``: ``lake`` (tables under ``lake_root/<table>``), ``jdbc`` or ``json``
    with ``sink_options`` (see ``sinks.batch_writer``); ``tables`` may also name
    ``enriched_events``, the enriched stream for publishing, and ``MORE_TABLES``. ``mode="update"`` (lake sink) keeps open windows visible.
    ``marks`` (lake sink) has the raw query mark the windows of late events for
    ``plans.repair``. Clean events lie in
    ``lake_root/_clean_events`` for ``retention``; checkpoints under
    ``checkpoint_root/<name>`` (default: the session's checkpoint folder). With a
    bounded trigger (``availableNow``) the ingest query is drained before the
    table queries start, so they see all of its output.
    """
    if (mode == "update" or marks) and sink != "lake":
        raise ValueError("update mode and marks need the lake sink")

    def ckpt_for(name: str) -> str:
        return (os.path.join(checkpoint_root, name) if checkpoint_root
                else stream_checkpoint(spark, name))

    def start(df: DataFrame, name: str, out_mode: str = "append") -> None:
        writer = sinks.batch_writer(sink, name, ckpt_for(name), lake_root, out_mode,
                                    **(sink_options or {}))
        if marks and name == "events":
            writer = sinks.also(writer, late_marker(lake_root, ckpt_for(name), watermark))
        started.append(start_query(df, name, writer, ckpt_for(name), out_mode, trigger))

    started: list[StreamingQuery] = []
    if staged:
        clean_path = os.path.join(lake_root, "_clean_events")
        ingest = start_ingest(records, clean_path, ckpt_for("clean_events"), trigger, retention)
        started.append(ingest)
        if trigger and trigger.get("availableNow"):
            ingest.awaitTermination()
            if ingest.exception() is not None:
                raise ingest.exception()
        ev = clean_stream(spark, clean_path)
    else:
        valid, _ = quality.validate(parse_events(records))
        ev = enrich_ops.enrich(valid)
    timed = watermarked(ev, watermark, dedup)
    register(timed)
    for name in tables or list(TABLE_BUILDERS):
        if name == "enriched_events":
            start(_enriched(spark, ev), name)
        elif name == "events":
            # keyed by id, nothing is late; the lake keeps the languages, too
            start((metrics.stored_events if sink == "lake" else metrics.raw_events)(ev), name)
        elif name in MORE_TABLES:
            start(MORE_TABLES[name](timed), name)
        else:
            start(TABLE_BUILDERS[name](timed), name, mode)
    if with_rejected:
        if staged:
            rejected = rejected_stream(spark, clean_path)
        else:
            rejected = quality.rejected_records(parse_events(records)).withColumn(
                "created_at", F.current_timestamp())
        start(rejected, "rejected_events")
    return started


def await_all(spark: SparkSession, queries: list[StreamingQuery], bounded: bool,
              timeout: float | None = None) -> None:
    """Bounded triggers (``availableNow``): wait for every query to drain.
    Unbounded: when the first query ends, stop the others and re-raise its error."""
    if bounded:
        for q in queries:
            q.awaitTermination(timeout)
            if q.exception() is not None:
                raise q.exception()
        return
    end = None if timeout is None else time.monotonic() + timeout
    while all(q.isActive for q in queries) and (end is None or time.monotonic() < end):
        time.sleep(0.5)
    ended = [q for q in queries if not q.isActive]
    if ended:
        for q in queries:
            if q.isActive:
                q.stop()
        for q in ended:
            if q.exception() is not None:
                raise q.exception()
