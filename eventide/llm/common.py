"""Helpers shared by the corpus operators: tables, scratch tables, sessions."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: rows and bytes per Arrow batch, so that neither long texts nor packed blocks pile up
ARROW_ROWS, ARROW_BYTES = 1000, 4 << 20
HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> SparkSession:
    """Session options the operators rely on (small Arrow batches, UTC)."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    # workers look for this package where the driver found it, too
    env = spark.sparkContext.environment
    if HOME not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [HOME, env.get("PYTHONPATH")]))
    return spark


def buckets_for(df: DataFrame, bucket_bytes: int, least: int = 48) -> int:
    """How many buckets to write from df, by the size that its plan estimates;
    an unknown size (a local or checkpointed table) counts as small. Never fewer
    than the shuffle partitions: Spark would shuffle the buckets anew."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(least, min(1 << 16, size // bucket_bytes)) if size < 1 << 60 else least


def bucketed(df: DataFrame, key: str, buckets: int, name: str) -> DataFrame:
    """df written once in the shared folder, bucketed by key: later joins and
    groups on the key read it in place, without a shuffle."""
    spark = df.sparkSession
    table = f"eventide_{name}_{uuid.uuid4().hex}"
    path = f"{shared_root(spark)}/eventide-llm/{table}"
    (df.write.format("parquet").option("compression", "uncompressed").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    stored = spark.table(table).select("*")
    spark.sql(f"DROP TABLE {table}")       # the name only; the files are external
    _delete_on_exit(spark, path)
    return stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where a local session names none (tests), a fresh temporary folder becomes
    its checkpoint folder; a cluster must name one.
    """
    root = (spark.conf.get("spark.checkpoint.dir", None)
            or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
            or spark.sparkContext.getCheckpointDir())
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("no checkpoint folder: set spark.checkpoint.dir to a shared path")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        root = spark.sparkContext.getCheckpointDir()
    return root


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a Parquet table in the shared folder, reread.

    Cuts lineage with a replicated copy, so a lost executor costs a re-read
    and not a recomputation. The folder goes when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/eventide-llm/{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    _delete_on_exit(spark, path.rsplit("/", 1)[0])
    return spark.read.schema(df.schema).parquet(path)


def bounded_ids(ids: DataFrame, bound: int) -> DataFrame:
    """The ``bound`` rows with the smallest hashes of column ``id`` (distinct ids).

    Where there are far more, a first cut on the hash leaves about twice the
    bound, so no task gathers more than that however many partitions there are.
    """
    spot = F.pmod(F.xxhash64("id"), F.lit(1 << 40))
    n = ids.count()
    if n > 4 * bound:
        ids = ids.where(spot < (1 << 41) * bound // n)
    return ids.orderBy(spot, "id").limit(bound)


def drop_written(df: DataFrame) -> None:
    """Remove the folder of a table made by ``written`` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished steps now: it
    does so when the driver collects the objects that stand for them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fresh(spark: SparkSession) -> None:
    """Before a long stage: executors hand back the heap that earlier stages have
    grown (a collection in each, by a task per core), as they share their memory
    with Python workers. Only a matter of space: tasks anywhere will do."""
    release(spark)
    n = spark.sparkContext.defaultParallelism
    (spark.range(0, n, 1, n).select(F.java_method(F.lit("java.lang.System"), F.lit("gc")))
     .write.format("noop").mode("overwrite").save())


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
