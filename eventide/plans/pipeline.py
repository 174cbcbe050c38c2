"""The batch pipeline over the driver tables: load -> land -> parse -> clean.

Stages are plain DataFrame transformations, so a query built on top is one
Catalyst plan from the Parquet scan to its result.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ensure_session
from ..functions.parse import parse_events
from ..functions.timefilters import ts_lit
from ..operators import enrich as enrich_ops
from ..operators import quality
from ..sources.adapter import landed_records

# --- fixed values: query parameters ------------------------------------------
AS_OF = "2024-01-31 00:00:00"          # "now" of the trailing-24 h reports
PANEL_FROM = "2024-01-29 00:00:00"     # dashboard time range
PANEL_TO = "2024-01-31 00:00:00"
RETENTION_AS_OF = "2024-02-15 00:00:00"
KEYED_APPEND_CUT = "2024-01-16 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    ensure_session(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def landed(spark: SparkSession, sf_dir: str, defects: bool = False,
           replays: bool = False) -> DataFrame:
    return landed_records(table(spark, sf_dir, "events"), defects=defects, replays=replays)


def parsed(spark: SparkSession, sf_dir: str, defects: bool = False,
           replays: bool = False, payload: str = "slim") -> DataFrame:
    """Parsed events; ``processed_at`` pinned to AS_OF for reproducible output."""
    return parse_events(landed(spark, sf_dir, defects, replays), processed_at=ts_lit(AS_OF),
                        payload=payload)


def clean(df: DataFrame, dedup: bool = True) -> DataFrame:
    """valid -> (deduplicated) -> enriched events."""
    valid, _ = quality.validate(df)
    if dedup:
        valid = quality.dedup(valid)
    return enrich_ops.enrich(valid)


def events(spark: SparkSession, sf_dir: str, dedup: bool = True, since=None, before=None,
           **kw) -> DataFrame:
    """Clean events; ``since`` / ``before`` bound ``created_at`` right after the
    parse, below de-duplication (copies of an id share their ``created_at``), so
    a report over a day does not shuffle the whole history."""
    df = parsed(spark, sf_dir, **kw)
    if since is not None:
        df = df.filter(F.col("created_at") >= ts_lit(since))
    if before is not None:
        df = df.filter(F.col("created_at") < ts_lit(before))
    return clean(df, dedup=dedup)


def ntz(df: DataFrame) -> DataFrame:
    """Instant timestamps -> wall-clock UTC (``timestamp_ntz``) for output.

    The session runs in UTC (``config.ensure_session``), so the cast keeps
    the UTC wall clock.
    """
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields])
