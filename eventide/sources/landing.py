"""Land transport records as files in event-time order (file-stream input).

A file stream reads files in modification-time order, and a watermark drops
rows older than the newest event seen in earlier batches. Replaying history
through a file stream therefore needs the files cut by event time and stamped
with increasing modification times; writing them quickly one after another
is not enough (equal timestamps come back in any order).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def land_in_time_order(spark: SparkSession, records: DataFrame, ts: str, path: str,
                       files: int | None = None) -> list[str]:
    """Write ``records`` (``key, value`` plus an event-time column ``ts``) to
    ``path`` as ``files`` Parquet files (default: the session's shuffle
    partitions), each holding one range of event times, stamped with increasing
    modification times in range order.

    One range-partitioned job writes all files in parallel; the driver lists
    them once and sets their names and times.
    """
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged = path.rstrip("/") + "_staged"
    (records.repartitionByRange(files, ts).select("key", "value")
            .write.mode("overwrite").parquet(staged))
    src_root, fs = _fs(spark, staged)
    dst_root, _ = _fs(spark, path)
    fs.mkdirs(dst_root)
    jvm = spark.sparkContext._jvm
    # part numbers are range numbers
    parts = sorted((s.getPath().getName(), s.getPath()) for s in fs.listStatus(src_root)
                   if s.getPath().getName().endswith(".parquet"))
    base_ms = int(time.time() * 1000) - 10_000 * (len(parts) + 1)
    landed = []
    for i, (name, part) in enumerate(parts):
        dst = jvm.org.apache.hadoop.fs.Path(dst_root, name)
        fs.rename(part, dst)
        fs.setTimes(dst, base_ms + i * 10_000, -1)
        landed.append(dst.toString())
    fs.delete(src_root, True)
    return landed


def landed_files(spark: SparkSession, path: str) -> list[str]:
    """The files of a landing folder, by listing it."""
    p, fs = _fs(spark, path)
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.isFile()
                  and not s.getPath().getName().startswith(("_", ".")))
