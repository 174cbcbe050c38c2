"""Event sources (K1) and served-table readers.

A message bus delivers ``(key, value)`` byte records; a landing directory
holds the same records as files. Both come out of here as a DataFrame with
``key`` and ``value`` columns that ``functions.parse.parse_events`` accepts,
batch or streaming.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import lake
from ..config import ensure_session
from ..schema import RECORD

FILE_FORMATS = ("parquet", "json", "text", "orc")


def event_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                 **options) -> DataFrame:
    """Streaming ``(key, value)`` records.

    * ``fmt="kafka"``: pass ``kafka.bootstrap.servers`` and ``subscribe``;
      defaults ``startingOffsets=latest``, ``failOnDataLoss=false``, and
      ``minPartitions`` = the cluster's parallelism: records are keyed by
      repository, so a hot repository fills one topic partition, and this
      splits its offset range over several tasks instead of one. Needs the
      Kafka connector on the classpath.
    * ``fmt="parquet"/"json"/"orc"``: landed ``(key, value)`` records under
      ``path``; ``maxFilesPerTrigger`` etc. pass through.
    * ``fmt="text"``: one JSON event per line under ``path``; ``key`` is null.
    """
    ensure_session(spark)
    if fmt == "kafka":
        opts = {"startingOffsets": "latest", "failOnDataLoss": "false",
                "minPartitions": str(spark.sparkContext.defaultParallelism), **options}
        return (spark.readStream.format("kafka").options(**opts).load()
                .select("key", "value"))
    reader = spark.readStream.options(**options)
    if fmt == "text":
        return reader.text(path).select(F.lit(None).cast("string").alias("key"),
                                        F.col("value"))
    if fmt not in FILE_FORMATS:
        raise ValueError(f"unknown source format {fmt!r}")
    return reader.schema(RECORD).format(fmt).load(path)


def event_batch(spark: SparkSession, fmt: str, path: str, **options) -> DataFrame:
    """The same records read as a bounded batch (backfills, replays)."""
    ensure_session(spark)
    if fmt == "kafka":
        opts = {"startingOffsets": "earliest", "failOnDataLoss": "false",
                "minPartitions": str(spark.sparkContext.defaultParallelism), **options}
        return spark.read.format("kafka").options(**opts).load().select("key", "value")
    reader = spark.read.options(**options)
    if fmt == "text":
        return reader.text(path).select(F.lit(None).cast("string").alias("key"),
                                        F.col("value"))
    return reader.schema(RECORD).format(fmt).load(path)


def metric_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A served table with its declared schema (0 rows before its first write).

    The ``window_date`` partition column is kept, so report predicates on
    ``window_start`` (which add the matching ``window_date`` bound) prune
    whole date directories before any file is opened.
    """
    return lake.read(spark, os.path.join(root, name), name)


def jdbc_table(spark: SparkSession, url: str, table: str, properties: dict[str, str],
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """A served table from a JDBC database; with a partition column the read is
    split into ``num_partitions`` parallel range queries."""
    ensure_session(spark)
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                               upperBound=upper, numPartitions=num_partitions,
                               properties=properties)
    return spark.read.jdbc(url, table, properties=properties)
