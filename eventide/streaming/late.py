"""Marks for windows that late events missed (T4).

A windowed aggregate drops an event that is older than the watermark; the raw
table takes it. Its writer marks the windows of such events in the table
``dirty_windows``, from which ``plans.repair`` recomputes them.

An event counts as late when it is older than the greatest event time of the
earlier micro-batches less the watermark's delay, as for the metric queries,
which read the same source with the same trigger. Marks are leaves of the
marking batch, so a replayed batch marks once.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import lake
from ..functions.timefilters import width_micros
from ..operators import metrics
from .sinks import query_id

DIRTY = "dirty_windows"


def _note(lake_root: str, owner: str, batch: int) -> str:
    return os.path.join(lake_root, DIRTY, "_high", f"{owner}-{batch}")


def _high(spark: SparkSession, path: str) -> int | None:
    """Greatest event time (microseconds) up to a batch; a one-line file."""
    return int(spark.read.text(path).first()[0]) if lake.exists(spark, path) else None


def mark_late(batch_df: DataFrame, batch_id: int, lake_root: str, checkpoint: str,
              delay: str) -> None:
    """Mark the windows of a micro-batch's late events; note its greatest time."""
    spark = batch_df.sparkSession
    owner = query_id(spark, checkpoint)
    top = batch_df.agg(F.max(F.unix_micros("created_at"))).first()[0]
    before = _high(spark, _note(lake_root, owner, batch_id - 1))
    if top is None and before is None:
        return
    if before is not None:
        late = batch_df.where(F.unix_micros("created_at") < before - width_micros(delay))
        windows = (late.select(metrics.event_window().alias("window")).distinct()
                   .select(F.col("window.start").alias("window_start"),
                           F.col("window.end").alias("window_end")))
        lake.append(windows, os.path.join(lake_root, DIRTY), DIRTY, f"{owner}-{batch_id}",
                    stored=True)
    high = max(x for x in (top, before) if x is not None)
    spark.createDataFrame([(str(high),)], "value string").coalesce(1).write.mode(
        "overwrite").text(_note(lake_root, owner, batch_id))
    lake.delete(spark, _note(lake_root, owner, batch_id - 2))   # a replay needs the last one


def watermark_of(spark: SparkSession, lake_root: str, delay: str) -> int | None:
    """The least of the marking queries' watermarks (microseconds)."""
    folder = os.path.join(lake_root, DIRTY, "_high")
    if not lake.exists(spark, folder):
        return None
    per_query = (spark.read.text(folder + "/*").select(        # two notes per query at most
        F.regexp_extract(F.input_file_name(), r"/_high/(.*)-\d+/", 1).alias("query"),
        F.col("value").cast("long").alias("high")).groupBy("query").agg(F.max("high").alias("high"))
        .agg(F.min("high")).first()[0])
    return None if per_query is None else per_query - width_micros(delay)


def late_marker(lake_root: str, checkpoint: str, delay: str) -> Callable[[DataFrame, int], None]:
    """``mark_late`` as a ``foreachBatch`` function."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        mark_late(batch_df, batch_id, lake_root, checkpoint, delay)
    return write
