"""Repair of closed windows that late events missed (T4).

The raw table's writer marks the windows of late events (``streaming.late``);
``repair`` recomputes only these windows, from the raw table, and upserts them by
key. Marked windows that the watermark has not passed stay marked, as the stream
would write over them (``ended`` says that it won't). Marks that it has read go when
its tables are written, and no others, so a repair that fails is run again and
marks that arrive meanwhile stay.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import lake
from ..operators import metrics
from ..streaming.late import DIRTY, watermark_of
from ..streaming.runner import DEFAULT_WATERMARK
from ..streaming.sinks import shape_for_table

DAY = dt.timedelta(days=1)
ROWS_PER_TASK = 100_000                # an event is a row of each window it lies in


def dirty_windows(spark: SparkSession, lake_root: str) -> DataFrame:
    return lake.read(spark, os.path.join(lake_root, DIRTY), DIRTY)


def _spread(raw: DataFrame) -> DataFrame:
    """Stored events over as many tasks as their rows need: a task that aggregates
    holds a row per entity and window, whatever the files' sizes."""
    tasks = max(int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                -(-raw.count() // ROWS_PER_TASK))
    return raw.repartition(tasks, "id")


def repair(spark: SparkSession, lake_root: str, tables: list[str] | None = None,
           delay: str = DEFAULT_WATERMARK, ended: bool = False) -> int:
    """Recompute the marked windows of the metric tables; returns how many.

    ``tables`` must be all metric tables that the lake holds: the marks go."""
    path = os.path.join(lake_root, DIRTY)
    marks = dirty_windows(spark, lake_root)
    seen = [(r[0], r[1]) for r in marks.select("window_date", "batch_id").distinct().collect()]
    if not seen:
        return 0
    batch_id = f"repair-{uuid.uuid4().hex}"
    # marks of batches that came while this runs are left to the next repair
    read = marks.where(F.col("window_date").isin(sorted({d for d, _ in seen})) & F.col(
        "batch_id").isin(sorted({b for _, b in seen}))).select("window_start", "window_end").distinct()
    upto = None if ended else watermark_of(spark, lake_root, delay)
    closed = F.lit(True) if upto is None else F.unix_micros("window_end") <= upto
    mine = read.where(closed).persist()
    try:
        dates = sorted(r[0] for r in mine.select(F.to_date("window_start")).distinct().collect())
        if not dates:
            return 0
        raw = _spread(lake.read(spark, os.path.join(lake_root, "events"), "events", extra=True)
                      .where(F.col("window_date").isin(sorted({*dates, *(d + DAY for d in dates)}))))
        for name in tables or list(metrics.METRIC_TABLES):
            rows = shape_for_table(metrics.METRIC_TABLES[name](metrics.from_stored(raw)), name)
            fixed = rows.join(mine, ["window_start", "window_end"], "left_semi").select(*rows.columns)
            lake.upsert(fixed, os.path.join(lake_root, name), name, batch_id)
        n = mine.count()
        # what is still open is marked anew before the marks that were read go
        lake.append(read.where(~closed), path, DIRTY, batch_id, stored=True)
        lake.drop_leaves(spark, path, seen)
        return n
    finally:
        mine.unpersist()
