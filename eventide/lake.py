"""Served tables on shared storage: one layout, keyed writes, upkeep.

A table is a folder of Parquet files in ``window_date=D/batch_id=B`` leaves.
``window_date`` is the date of ``window_start`` (of ``created_at`` for raw
events) and prunes reads; ``batch_id`` names the writer: a streaming query's id
and micro-batch, a build, or a compaction. Streams and builds share the layout,
so they can share a table.

Every write is idempotent. A writer replaces only its own leaves, each as a
whole, and adds only rows whose unique key no other leaf holds, so a replayed
batch, a new checkpoint or a second build writes nothing twice. What replaces
rows of other writers says so: ``upsert`` (by key), ``replace_windows`` (metric
windows recomputed from the raw table) and ``replace_dates``.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .config import ensure_session, scratch_dir
from .operators import quality
from .schema import TABLE_CLUSTER, TABLE_EXTRA, TABLE_KEYS, TABLE_SCHEMAS

LAYOUT = T.StructType([T.StructField("window_date", T.DateType()),
                       T.StructField("batch_id", T.StringType())])
ROWS_PER_FILE = 500_000


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def read(spark: SparkSession, path: str, table: str | None = None,
         extra: bool = False) -> DataFrame:
    """A table with its declared schema plus the layout columns (and, with
    ``extra``, what is stored beside the contract); a table that has no rows yet
    reads as 0 rows."""
    ensure_session(spark)
    name = table or os.path.basename(path.rstrip("/"))
    declared = TABLE_SCHEMAS.get(name)
    if declared is None:
        return spark.read.parquet(path)
    more = TABLE_EXTRA[name].fields if extra and name in TABLE_EXTRA else []
    full = T.StructType(declared.fields + more + LAYOUT.fields)
    if not exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


def dated(df: DataFrame) -> DataFrame:
    ts = "window_start" if "window_start" in df.columns else "created_at"
    return df.withColumn("window_date", F.to_date(F.col(ts)))


def absent(batch: DataFrame, target: DataFrame, key: list[str],
           same_date: bool = True) -> DataFrame:
    """Rows of ``batch`` whose ``key`` the target lacks (null-safe)."""
    on = list(key)
    if same_date and "window_date" in batch.columns and "window_date" in target.columns:
        on.append("window_date")
    held = target.select(*[F.col(c).alias(f"_held_{c}") for c in on])
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"_held_{c}"))
    return batch.join(held, same, "left_anti")


def one_per_key(df: DataFrame, table: str | None) -> DataFrame:
    """Copies inside one batch: of an event, the first collected stays; of a
    rejected record, one."""
    if table == "rejected_events":
        return df.dropDuplicates(list(TABLE_KEYS[table]))
    return quality.dedup(df) if table == "events" else df


def write(df: DataFrame, path: str, table: str | None, batch_id: str) -> None:
    """Replace the leaves of ``batch_id`` on the dates of ``df`` (already dated)."""
    (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("window_date", "batch_id").parquet(path))


def clustered(df: DataFrame, table: str | None, rows: int | None = None) -> DataFrame:
    """Sorted runs of (date, entity) per task, range-partitioned; the table's key
    also splits a date or entity with many rows. With ``rows`` known, a task sorts
    about ``ROWS_PER_FILE`` at most, and few rows need no sampling pass. Always
    behind a shuffle: what computes ``df`` keeps its own tasks."""
    keys = ["window_date"] + [c for c in ("batch_id", TABLE_CLUSTER.get(table or ""))
                              if c in df.columns]
    apart = keys + [c for c in TABLE_KEYS.get(table or "", ()) if c not in keys]
    if rows is None:
        df = df.repartitionByRange(*apart)
    elif rows <= ROWS_PER_FILE:
        df = df.repartition(1)
    else:
        df = df.repartitionByRange(-(-rows // ROWS_PER_FILE), *apart)
    return df.sortWithinPartitions(*keys)


def append(df: DataFrame, path: str, table: str | None, batch_id: str,
           stored: bool = False, any_date: bool = False) -> None:
    """Insert if absent: the rows (in table shape) whose key no other leaf holds.

    Only leaves of the batch's own dates are compared, however far apart they
    are; ``any_date`` compares all leaves, for keys whose date can change. A
    ``stored`` batch is a table of distinct keys that can be read again."""
    spark = df.sparkSession
    batch = dated(df) if stored else one_per_key(dated(df), table).persist()
    try:
        days = batch.groupBy("window_date").count().collect()        # a row per date
        dates = sorted(r[0] for r in days if r[0] is not None)
        if not dates:
            return
        key = TABLE_KEYS.get(table or "")
        new = batch
        if key and exists(spark, path):
            others = read(spark, path, table).filter(F.col("batch_id") != batch_id)
            if not any_date:
                others = others.filter(F.col("window_date").isin(dates))
            new = absent(batch, others, list(key), same_date=not any_date)
        write(clustered(new, table, sum(r[1] for r in days)), path, table, batch_id)
    finally:
        if not stored:
            batch.unpersist()


def leaves(spark: SparkSession, path: str, dates: list[dt.date]) -> list[tuple[dt.date, str]]:
    """(date, batch_id) of the leaves of some dates, by listing them."""
    out = []
    for date in dates:
        p, fs = _fs(spark, os.path.join(path, f"window_date={date.isoformat()}"))
        if fs.exists(p):
            out += [(date, s.getPath().getName().partition("=")[2]) for s in fs.listStatus(p)
                    if s.isDirectory() and s.getPath().getName().startswith("batch_id=")]
    return out


def drop_leaves(spark: SparkSession, path: str, gone: list[tuple[dt.date, str]]) -> None:
    for date, batch_id in gone:
        delete(spark, os.path.join(path, f"window_date={date.isoformat()}", f"batch_id={batch_id}"))


def upsert(df: DataFrame, path: str, table: str, batch_id: str) -> None:
    """Rows replace those of the same key: the touched dates are written anew as
    one leaf, then their other leaves go. Run again after a failure, it finds
    its own copy and older ones, which agree on every key the batch lacks.

    Batch and stored rows meet in one shuffle by key, of as many tasks as their
    rows need: a micro-batch is not planned adaptively."""
    spark = df.sparkSession
    batch = dated(df).persist()
    try:
        days = batch.groupBy("window_date").count().collect()        # a row per date
        dates = sorted(r[0] for r in days)
        if not dates:
            return
        out, rows = batch, sum(r[1] for r in days)
        if exists(spark, path):
            key = list(TABLE_KEYS[table])
            stored = read(spark, path, table, True).filter(F.col("window_date").isin(dates))
            rows += stored.count()
            staged = scratch_dir(spark, "upsert")     # the leaf is read and replaced
            _replaced(batch, stored, key, batch_id, rows).write.parquet(staged)
            out = spark.read.schema(batch.schema).parquet(staged)
        old = leaves(spark, path, dates)
        write(clustered(out, table), path, table, batch_id)
        drop_leaves(spark, path, [x for x in old if x[1] != batch_id])
        if out is not batch:
            delete(spark, staged)
    finally:
        batch.unpersist()


def _replaced(batch: DataFrame, stored: DataFrame, key: list[str], batch_id: str,
              rows: int) -> DataFrame:
    """The batch, and one stored row (this batch's own copy first) of each key that
    it lacks on the row's date. A task gets about ``ROWS_PER_FILE`` of ``rows``."""
    spark = batch.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_FILE))
    both = batch.withColumns({"_new": F.lit(1), "_own": F.lit(0)}).unionByName(
        stored.withColumns({"_new": F.lit(0), "_own": (F.col("batch_id") == batch_id).cast("int")})
        .drop("batch_id")).repartition(tasks, *key)
    same_day = Window.partitionBy(*key, "window_date")
    copies = Window.partitionBy(*key, "_new").orderBy(F.desc("_own"))
    return (both.withColumn("_held", F.max("_new").over(same_day))
            .filter("_new = 1 OR _held = 0")
            .withColumn("_n", F.row_number().over(copies))
            .filter("_new = 1 OR _n = 1").drop("_new", "_own", "_held", "_n"))


def replace_windows(df: DataFrame, path: str, table: str, batch_id: str, dates: list[dt.date],
                    stays: Column | None = None) -> None:
    """Recomputed rows of whole window dates replace the table's; stored rows for
    which ``stays`` holds (windows of another width) are carried over. Run again
    after a failure, it finds its own copy and writes the same rows."""
    if not dates:
        return
    spark = df.sparkSession
    inside = F.col("window_date").isin(dates)
    out = dated(df).filter(inside)
    old, staged = leaves(spark, path, dates), None
    if stays is not None and old:
        staged = scratch_dir(spark, "windows")        # a leaf is read and replaced
        (read(spark, path, table).filter(inside & stays).drop("batch_id")
         .dropDuplicates(list(TABLE_KEYS[table])).write.parquet(staged))
        out = out.unionByName(spark.read.schema(out.schema).parquet(staged))
    write(clustered(out, table), path, table, batch_id)
    drop_leaves(spark, path, [x for x in old if x[1] != batch_id])
    if staged:
        delete(spark, staged)


def replace_dates(df: DataFrame, path: str, table: str, batch_id: str,
                  dates: list[dt.date]) -> None:
    """Rows of these dates replace what the table holds on them; rows of other
    dates (windows begun before the first date) are inserted if absent."""
    spark = df.sparkSession
    rows = dated(df)
    inside = F.col("window_date").isin(dates) if dates else F.lit(False)
    old = leaves(spark, path, dates)
    write(clustered(rows.filter(inside), table), path, table, batch_id)
    drop_leaves(spark, path, [x for x in old if x[1] != batch_id])
    append(rows.filter(~inside).drop("window_date"), path, table, batch_id)


def expire(spark: SparkSession, path: str, table: str, expired: Column,
           horizon: dt.date) -> tuple[int, int]:
    """Retention: delete the leaves whose rows are all expired, rewrite those
    that hold both kinds. No row dated after ``horizon`` may be expired, so
    later leaves are not read. Returns (deleted, rewritten). The horizon of the
    raw table is noted in its folder: up to it, events may be missing."""
    if not exists(spark, path):
        return 0, 0
    if table == "events":
        _note_horizon(spark, path, horizon)
    old = read(spark, path, table, True).filter(F.col("window_date") <= F.lit(horizon))
    seen = (old.groupBy("window_date", "batch_id")
            .agg(F.count("*").alias("n"), F.count_if(expired).alias("gone"))
            .filter("gone > 0").collect())            # a row per old leaf
    whole = [(r.window_date, r.batch_id) for r in seen if r.gone == r.n]
    part = [(r.window_date, r.batch_id) for r in seen if r.gone < r.n]
    left = sum(r.n - r.gone for r in seen)
    if part:
        staged = scratch_dir(spark, "retain")
        which = spark.createDataFrame(part, LAYOUT)
        old.filter(~expired).join(which, LAYOUT.names, "left_semi").write.parquet(staged)
        kept = spark.read.schema(old.schema).parquet(staged)
        (clustered(kept, table, left).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy("window_date", "batch_id").parquet(path))
        delete(spark, staged)
    drop_leaves(spark, path, whole)
    return len(whole), len(part)


def horizon_of(spark: SparkSession, path: str) -> dt.date | None:
    """The last date up to which retention may have taken rows of this table."""
    note = os.path.join(path, "_horizon")
    if not exists(spark, note):
        return None
    days = spark.read.text(note).collect()               # one line per note
    return max((dt.date.fromisoformat(r[0]) for r in days if r[0]), default=None)


def _note_horizon(spark: SparkSession, path: str, horizon: dt.date) -> None:
    known = horizon_of(spark, path)
    if known is None or known < horizon:
        spark.createDataFrame([(horizon.isoformat(),)], "value string").coalesce(1).write.mode(
            "append").text(os.path.join(path, "_horizon"))


def compact(spark: SparkSession, path: str, table: str, before: dt.date) -> int:
    """Merge the leaves of each date before ``before`` into one; returns how many
    dates changed. Rows and keys stay, so later replays still insert nothing."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return 0
    dates = []
    for s in fs.listStatus(p):
        name, _, value = s.getPath().getName().partition("=")
        if name == "window_date" and value < before.isoformat():
            dates.append(dt.date.fromisoformat(value))
    old = leaves(spark, path, dates)
    many = sorted({d for d, _ in old if sum(x[0] == d for x in old) > 1})
    if not many:
        return 0
    batch_id = f"compact-{uuid.uuid4().hex}"
    rows = read(spark, path, table, True).filter(F.col("window_date").isin(many)).drop("batch_id")
    write(clustered(rows, table), path, table, batch_id)
    drop_leaves(spark, path, [x for x in old if x[0] in set(many)])
    return len(many)
