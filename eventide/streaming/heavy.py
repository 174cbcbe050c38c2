"""Heavy hitters per window with bounded custom state and timers (T5).

Which repositories have more than a share of a window's events, without a counter
per repository: a bounded summary of counters per (window, shard). An event's
shard comes from its id, so a repository with a third of all events is spread over
all shards. A summary with ``COUNTERS`` counters is merged with a batch's counts;
of more entries than counters the greatest that doesn't fit is taken off all, and
what was taken off in total (``lost``, at most events / (COUNTERS + 1)) bounds the
error: a count is at least ``count`` and at most ``count + lost``, and a repository
without a counter has at most ``lost``. Summaries add up over shards, and so do
their errors.

The state of a (window, shard) lives from its first event to the timer at the
window's end, at which it is emitted and removed: the watermark passes it once,
restarts included. Needs the RocksDB state store.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.temporal import slot
from ..functions.timefilters import width_micros

COUNTERS = 256
SHARDS = 8
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SUMMARY = "window_start long, shard int, repo_id long, count long, lost long, total long"


def folded(counts: pd.Series, more: pd.Series, counters: int) -> tuple[pd.Series, int]:
    """Two summaries' counters as one of at most ``counters``, and what was taken off."""
    both = counts.add(more, fill_value=0).astype("int64")
    if len(both) <= counters:
        return both, 0
    off = int(both.nlargest(counters + 1).iloc[-1])
    return (both - off)[both > off], off


class Summaries(StatefulProcessor):
    """State per (window, shard): counters, what was taken off, events."""

    def __init__(self, size: int, counters: int):
        self.size, self.counters = size, counters

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(
            "summary", "repos array<bigint>, counts array<bigint>, lost bigint, total bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.state.get() if self.state.exists() else None
        counts = pd.Series(dict(zip(held[0], held[1])) if held else {}, dtype="int64")
        lost, total = (held[2], held[3]) if held else (0, 0)
        for part in rows:
            counts, off = folded(counts, part["repo_id"].value_counts(), self.counters)
            lost, total = lost + off, total + len(part)
        if held is None:
            self.handle.registerTimer((key[0] + self.size) // 1000)
        self.state.update(([int(x) for x in counts.index], [int(x) for x in counts], lost, total))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        repos, counts, lost, total = self.state.get()
        self.state.clear()
        yield pd.DataFrame({"window_start": key[0], "shard": key[1], "repo_id": list(repos) or [-1],
                            "count": list(counts) or [0], "lost": lost, "total": total})

    def close(self) -> None:
        pass


def summaries(events: DataFrame, size: str = "1 day", shards: int = SHARDS,
              counters: int = COUNTERS) -> DataFrame:
    """Stream of summaries (``SUMMARY``) of watermarked events, as windows close."""
    micros = width_micros(size)
    rows = events.select(
        slot(F.col("created_at"), micros).alias("window_start"),
        F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"),
        F.col("repo.id").alias("repo_id"), "created_at")
    return rows.groupBy("window_start", "shard").transformWithStateInPandas(
        Summaries(micros, counters), SUMMARY, "append", "EventTime")


def heavy(stored: DataFrame, share: float) -> DataFrame:
    """Repositories that may have ``share`` of a window's events or more: bounds of
    their count, and the window's events. None that has it is missing."""
    window = stored.groupBy("window_start", "shard").agg(
        F.max("lost").alias("lost"), F.max("total").alias("total")).groupBy("window_start").agg(
        F.sum("lost").alias("lost"), F.sum("total").alias("total"))
    counts = (stored.where("repo_id >= 0").groupBy("window_start", "repo_id")
              .agg(F.sum("count").alias("at_least")))
    return (counts.join(window, "window_start")
            .withColumn("at_most", F.col("at_least") + F.col("lost"))
            .where(F.col("at_most") >= F.col("total") * share)
            .select(F.timestamp_micros("window_start").alias("window_start"), "repo_id", "at_least",
                    "at_most", F.col("total").alias("window_events")))


def needs(spark: SparkSession) -> None:
    """Custom state needs the RocksDB store; the session takes it from here on."""
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != STORE:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
