"""Session options the engine relies on.

The cluster (or the test) owns the session. We set UTC session time, so event-time
windows and the timestamp_ntz views of them are independent of the driver's local
zone, and one plan option that no cluster setting stands for.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

SESSION_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    # a hot user's sessions leave a streaming task merged, before the shuffle
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def ensure_session(spark: SparkSession) -> SparkSession:
    for k, v in SESSION_OPTIONS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for streaming checkpoints and lineage cuts.

    Read from the session (``spark.checkpoint.dir``, the cluster's shared
    folder, then ``spark.sql.streaming.checkpointLocation``); never a
    machine-local default.
    """
    for key in ("spark.checkpoint.dir", "spark.sql.streaming.checkpointLocation"):
        v = spark.conf.get(key, None)
        if v:
            return v
    v = (spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
         or spark.sparkContext.getCheckpointDir())
    if v:
        return v
    raise RuntimeError(
        "no checkpoint folder: set spark.checkpoint.dir to a shared path")


def scratch_dir(spark: SparkSession, owner: str) -> str:
    """A fresh folder in the shared checkpoint folder, removed when the
    driver ends."""
    path = os.path.join(checkpoint_root(spark), "eventide-runs", f"{owner}-{uuid.uuid4().hex}")
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path


def stream_checkpoint(spark: SparkSession, query_name: str) -> str:
    """Per-query checkpoint directory (named, so a restart resumes)."""
    return os.path.join(checkpoint_root(spark), "streams", query_name)


def builder(master: str = "local[*]", shuffle_partitions: int = 8):
    """Session builder for tests and the bench (clusters bring their own)."""
    return (
        SparkSession.builder.master(master)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state."
                "RocksDBStateStoreProvider")
        # commit a changelog per micro-batch, snapshot in the background
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    )
