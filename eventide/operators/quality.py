"""Validation, type flagging and de-duplication of parsed events.

Validity is a column, not an exception: each row gets the list of required
fields it lacks; rows with an empty list are valid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import KNOWN_EVENT_TYPES

# --- fixed values: required fields of an event -------------------------------
REQUIRED_FIELDS = (
    "id", "type",
    "actor.id", "actor.login", "actor.url", "actor.avatar_url",
    "repo.id", "repo.name", "repo.url",
    "public", "created_at", "payload",
    "collected_at",          # null only where the record has an unreadable one
)
# when ``org`` is present these of its fields are required
REQUIRED_ORG_FIELDS = ("org.id", "org.login", "org.url", "org.avatar_url")


def error_list() -> Column:
    """``array<string>`` of missing required fields (empty when valid)."""
    checks = [F.when(F.col(f).isNull(), F.lit(f)) for f in REQUIRED_FIELDS]
    checks += [F.when(F.col("org").isNotNull() & F.col(f).isNull(), F.lit(f))
               for f in REQUIRED_ORG_FIELDS]
    return F.array_compact(F.array(*checks))


def validate(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split parsed events into ``(valid, rejected)``.

    ``rejected`` is a report: id and type (``"unknown"`` when absent), the
    comma-joined list of missing fields, and the transport key.
    """
    valid = df.filter(F.size(error_list()) == 0)
    return valid, rejected_records(df).drop("record_id")


def rejected_records(df: DataFrame) -> DataFrame:
    """The report of ``validate`` with ``record_id``, the key of its table."""
    return df.select(
        F.coalesce(F.col("id"), F.lit("unknown")).alias("id"),
        F.coalesce(F.col("type"), F.lit("unknown")).alias("type"),
        F.array_join(error_list(), ",").alias("errors"),
        "event_key", "record_id",
    ).filter(F.col("errors") != "")


def flag_unknown_type(df: DataFrame) -> DataFrame:
    """Keep every row; add ``known_type`` (false for names outside the list)."""
    return df.withColumn("known_type", F.col("type").isin(*KNOWN_EVENT_TYPES))


def unknown_type_counts(df: DataFrame) -> DataFrame:
    """How many events of each unknown type arrived (batch report)."""
    return (flag_unknown_type(df).filter(~F.col("known_type"))
            .groupBy(F.col("type").alias("event_type"))
            .agg(F.count(F.lit(1)).alias("event_count")))


def dedup(df: DataFrame, key: str = "id", order: str = "collected_at") -> DataFrame:
    """One row per ``key``: the copy collected first, whole.

    Copies collected at the same instant are ordered by type and then by the
    hash of the record's text, so the kept row is always one that was sent.
    ``row_number() = 1`` is a group limit in the plan: each task keeps one row
    per key before the shuffle, so a key with billions of copies collapses
    there, every column crosses the network once, and unused columns are pruned.
    """
    tie = ([c for c in ("type", "record_hash") if c in df.columns and c != key]
           if "record_hash" in df.columns else
           [F.xxhash64(*[F.to_json(F.col(f.name)) if isinstance(f.dataType, T.MapType)
                         else F.col(f.name) for f in df.schema.fields])])
    first = Window.partitionBy(key).orderBy(order, *tie)
    return (df.withColumn("_copy", F.row_number().over(first))
            .filter(F.col("_copy") == 1).drop("_copy"))


def dedup_stream(df: DataFrame, key: str = "id") -> DataFrame:
    """Streaming de-duplication; state is bounded by the watermark."""
    return df.dropDuplicatesWithinWatermark([key])
