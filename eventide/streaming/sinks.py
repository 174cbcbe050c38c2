"""Sinks: lake tables, JDBC, keyed JSON records (K2-K6).

Delivery is at-least-once: a failed write fails the batch and it is replayed.
The lake sinks are keyed and replace only what their own batch wrote before
(see ``lake``); the JDBC sink inserts only absent keys. Keyed JSON to a topic
stays at-least-once, as a message bus is.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import lake
from ..schema import TABLE_EXTRA, TABLE_KEYS


def arrays_to_text(df: DataFrame, sep: str = ",", keep: Sequence[str] = ()) -> DataFrame:
    """Every array column but those to ``keep`` -> its elements joined by ``sep``
    (nulls skipped)."""
    return df.select(*[
        F.array_join(F.col(f.name), sep).alias(f.name)
        if isinstance(f.dataType, T.ArrayType) and f.name not in keep else F.col(f.name)
        for f in df.schema.fields])


def shape_for_table(df: DataFrame, table: str | None = None) -> DataFrame:
    """The column shape of a served table: flat window bounds, text arrays (what
    the lake stores beside the contract stays as it is)."""
    if "window" in df.columns:
        df = df.withColumns({"window_start": F.col("window.start"),
                             "window_end": F.col("window.end")}).drop("window")
    extra = [c for c in (TABLE_EXTRA[table].names if table in TABLE_EXTRA else [])
             if c in df.columns]
    return arrays_to_text(df, keep=extra)


def to_keyed_json(df: DataFrame, key_col: str | None = "repo_name") -> DataFrame:
    """``(key, value)`` records: key = ``key_col`` (null when absent), value =
    the row as JSON text with null fields written out."""
    key = F.col(key_col) if key_col else F.lit(None).cast("string")
    return df.select(
        key.cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns]),
                  {"ignoreNullFields": "false"}).alias("value"))


def write_kafka(records: DataFrame, servers: str, topic: str, **options):
    """Publish ``(key, value)`` records to a topic (batch or stream writer).

    Needs the Kafka connector on the classpath. ``acks=all`` and retries make
    the producer at-least-once, as the collector's was.
    """
    opts = {"kafka.bootstrap.servers": servers, "topic": topic,
            "kafka.acks": "all", "kafka.retries": "5", **options}
    if records.isStreaming:
        return records.writeStream.format("kafka").options(**opts)
    return records.write.format("kafka").options(**opts).save()


def keyed_append(batch: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose ``key`` is absent from ``target`` (insert-if-absent).

    A left-anti join; when both sides carry the ``window_date`` partition
    column it joins on it too.
    """
    return lake.absent(batch, target, list(key))


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The streaming query's own id: it lives and dies with its checkpoint."""
    line = spark.read.text(os.path.join(checkpoint, "metadata")).first()[0]
    return json.loads(line)["id"]


def lake_batch_writer(path: str, table: str | None = None, checkpoint: str | None = None,
                      mode: str = "append") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function writing each micro-batch to a lake table.

    A batch is identified by the query (by its checkpoint's id) and its number.
    ``append`` inserts rows with absent keys, ``update`` replaces rows by key.
    Empty batches are skipped.
    """
    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        owner = query_id(spark, checkpoint) if checkpoint else "direct"
        put = lake.upsert if mode == "update" else lake.append
        put(shape_for_table(batch_df, table), path, table, f"{owner}-{batch_id}")
    return write


def also(*writers: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Writers one after the other; a batch that fails in one is run again in all."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.persist()
        try:
            for w in writers:
                w(batch_df, batch_id)
        finally:
            batch_df.unpersist()
    return write


def json_batch_writer(table: str, checkpoint: str, path: str | None = None,
                      servers: str | None = None, topic: str | None = None,
                      key_col: str = "repo_name") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function publishing keyed JSON: to a topic, or as files
    of records under ``path/table/batch=...`` (a replay replaces its own)."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        if batch_df.isEmpty():
            return
        shaped = batch_df if table == "enriched_events" else shape_for_table(batch_df)
        records = to_keyed_json(shaped, key_col if key_col in shaped.columns else shaped.columns[0])
        if servers:
            write_kafka(records, servers, topic or table)
        else:
            owner = query_id(batch_df.sparkSession, checkpoint)
            records.write.mode("overwrite").parquet(
                os.path.join(path, table, f"batch={owner}-{batch_id}"))
    return write


def _time_ranges(ts: str, lo, hi, parts: int = 8) -> list[str]:
    """Predicates that split ``[lo, hi]`` evenly: parallel JDBC range reads."""
    step = (hi - lo) / parts
    ends = [lo + step * k for k in range(parts)] + [hi]
    return [f"{ts} >= '{a}' AND {ts} {'<=' if k == parts - 1 else '<'} '{b}'"
            for k, (a, b) in enumerate(zip(ends[:-1], ends[1:]))]


def jdbc_batch_writer(table: str, url: str, properties: dict[str, str],
                      key: Sequence[str] | None = None,
                      writer: Callable[[DataFrame], None] | None = None,
                      reader: Callable[[], DataFrame] | None = None
                      ) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function appending each micro-batch to a JDBC table.

    With ``key``, rows already present in the table (by key) are skipped, so a
    replayed batch inserts nothing twice. Only the slice of the table inside
    the batch's time range is read back, split into parallel range queries. Write
    errors propagate and fail the batch (it is retried), they are never swallowed.
    ``writer`` / ``reader`` replace the JDBC write / read (tests).
    """
    def default_writer(df: DataFrame) -> None:
        df.write.jdbc(url=url, table=table, mode="append", properties=properties)

    write_fn = writer or default_writer

    def write(batch_df: DataFrame, batch_id: int) -> None:
        shaped = shape_for_table(batch_df).persist()
        try:
            if shaped.isEmpty():
                return
            out = shaped
            if key:
                ts = "window_start" if "window_start" in shaped.columns else "created_at"
                lo, hi = shaped.agg(F.min(ts), F.max(ts)).first()
                existing = (reader() if reader else batch_df.sparkSession.read.jdbc(
                    url, table, predicates=_time_ranges(ts, lo, hi), properties=properties))
                existing = existing.filter(F.col(ts).between(F.lit(lo), F.lit(hi)))
                out = keyed_append(shaped, existing, key)
            write_fn(out)
        finally:
            shaped.unpersist()
    return write


def batch_writer(kind: str, table: str, checkpoint: str, lake_root: str, mode: str = "append",
                 **options) -> Callable[[DataFrame, int], None]:
    """The sink of a served table: ``lake``, ``jdbc`` (url, properties, or writer
    and reader in tests) or ``json`` (path, or servers and topic)."""
    if kind == "lake":
        return lake_batch_writer(os.path.join(lake_root, table), table, checkpoint, mode)
    if kind == "jdbc":
        known = {k: options.pop(k) for k in ("url", "writer", "reader") if k in options}
        return jdbc_batch_writer(table, known.get("url", ""), options, TABLE_KEYS.get(table),
                                 known.get("writer") and (lambda df: known["writer"](table, df)),
                                 known.get("reader") and (lambda: known["reader"](table)))
    if kind == "json":
        return json_batch_writer(table, checkpoint, **{"path": os.path.join(lake_root, "_json"),
                                                       **options})
    raise ValueError(f"unknown sink {kind!r}")


def expire_landed_files(spark, path: str, max_age_hours: float, now_ms: int | None = None) -> int:
    """Time-based retention of a landing directory (the message bus's
    ``retention.ms``): delete landed files older than ``max_age_hours`` by
    modification time, whether or not a stream has read them. Returns the
    number of files deleted. (A file stream can instead remove what it has
    processed with its own ``cleanSource`` option.)
    """
    import time as _time
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return 0
    now_ms = int(_time.time() * 1000) if now_ms is None else now_ms
    cutoff = now_ms - int(max_age_hours * 3_600_000)
    deleted = 0
    for st in fs.listStatus(root):
        if st.isFile() and st.getModificationTime() < cutoff \
                and not st.getPath().getName().startswith(("_", ".")):
            fs.delete(st.getPath(), False)
            deleted += 1
    return deleted
