"""Batch build of the served tables (backfill / reprocessing).

At scale the expensive steps are the JSON parse and the de-duplication shuffle.
They run once: clean, enriched events are written as a Parquet table partitioned
by event date (a lineage cut in the shared folder, private to the build), and
the raw-event and four metric tables are then aggregated from its pruned columns.

A build may be partial: its events are inserted into the lake's raw table where
their id is absent, and the metric windows they touch are recomputed from that
table, so parts built in any order, overlapping or twice, give what one build of
everything gives. Where the raw table can't know all events of a window (its
retention has passed, or the metric table was fed without it), absent windows
are inserted and stored ones stay. Only ``replace`` replaces whole dates by the
input alone. Rejected records go to ``rejected_events``, each once.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import lake
from ..config import scratch_dir
from ..functions.timefilters import window_width_is
from ..operators import distinct, metrics
from ..schema import WINDOW_SIZE
from ..streaming.sinks import shape_for_table

BUILDERS = {"events": metrics.raw_events, **metrics.METRIC_TABLES}
#: built where asked to
MORE_BUILDERS = {"user_repositories": distinct.user_repository_sketches}


def _builder(name: str):
    return BUILDERS.get(name) or MORE_BUILDERS[name]


def build_tables(spark: SparkSession, clean_events: DataFrame, lake_root: str,
                 tables: list[str] | None = None, rejected: DataFrame | None = None,
                 replace: bool = False) -> dict[str, str]:
    """Write the raw table, the metric ``tables`` and ``rejected_events`` (as
    ``quality.rejected_records`` reports them); returns their paths."""
    staged = scratch_dir(spark, "build")
    # out of the de-duplication exchange (hash on id) every task holds every
    # date; rebalancing on the date (AQE splits big dates, merges small ones)
    # writes a few large files per date instead of one per task and date
    (clean_events.withColumn("event_date", F.to_date("created_at"))
        .hint("rebalance", "event_date")
        .write.partitionBy("event_date").parquet(staged))
    stored = spark.read.schema(T.StructType(
        clean_events.schema.fields + [T.StructField("event_date", T.DateType())])).parquet(staged)
    dates = sorted(r[0] for r in stored.select("event_date").distinct().collect())  # days
    clean = stored.drop("event_date")
    batch_id = f"build-{uuid.uuid4().hex}"
    names = ["events"] + [n for n in tables or BUILDERS if n != "events"]
    paths = {name: os.path.join(lake_root, name) for name in names}
    if replace:
        for name in names:
            make = metrics.stored_events if name == "events" else _builder(name)
            lake.replace_dates(shape_for_table(make(clean), name), paths[name], name, batch_id, dates)
    else:
        _merge(spark, clean, paths, batch_id, dates)
    if rejected is not None:
        paths["rejected_events"] = os.path.join(lake_root, "rejected_events")
        lake.append(rejected.withColumn("created_at", F.current_timestamp()),
                    paths["rejected_events"], "rejected_events", batch_id, any_date=True)
    lake.delete(spark, staged)
    return paths


def _merge(spark: SparkSession, clean: DataFrame, paths: dict[str, str], batch_id: str,
           dates: list[dt.date]) -> None:
    """Insert events by id, then recompute the windows that they touch."""
    day = dt.timedelta(days=1)
    touched = sorted({d - back for d in dates for back in (0 * day, day)})
    known = {d for d, _ in lake.leaves(spark, paths["events"], [*touched, *(d + day for d in touched)])}
    lake.append(shape_for_table(metrics.stored_events(clean), "events"), paths["events"], "events",
                batch_id, stored=True)
    for name in paths:
        if name != "events":
            held = {d for d, _ in lake.leaves(spark, paths[name], touched)}
            # a date whose windows were fed without the raw table is not recomputed
            blind = {d for d in held if d not in known and d + day not in known}
            rebuild_windows(spark, paths, name, batch_id, [d for d in touched if d not in blind],
                            clean, sorted(blind))


def rebuild_windows(spark: SparkSession, paths: dict[str, str], name: str, batch_id: str,
                    dates: list[dt.date], clean: DataFrame | None = None,
                    blind: list[dt.date] = ()) -> None:
    """Recompute a metric table's windows that begin on ``dates`` from the raw
    table. Dates that its retention has reached, and ``blind`` ones, only take
    absent windows, from ``clean`` if given."""
    day = dt.timedelta(days=1)
    horizon = lake.horizon_of(spark, paths["events"])
    whole = [d for d in dates if horizon is None or d > horizon]
    rest = sorted({*dates, *blind} - set(whole))
    if whole:
        raw = lake.read(spark, paths["events"], "events", extra=True).filter(
            F.col("window_date").isin(sorted({*whole, *(d + day for d in whole)})))
        if name == "language_trends" and not raw.filter(F.col("languages").isNull()).isEmpty():
            raise ValueError("raw events without their languages: language_trends can't be "
                             "recomputed from them; build with replace")
        rows = shape_for_table(_builder(name)(metrics.from_stored(raw)), name)
        lake.replace_windows(rows, paths[name], name, batch_id, whole,
                             ~window_width_is("window_start", "window_end", WINDOW_SIZE))
    if rest and clean is not None:
        rows = lake.dated(shape_for_table(_builder(name)(clean), name))
        lake.append(rows.filter(F.col("window_date").isin(rest)).drop("window_date"), paths[name],
                    name, batch_id)
