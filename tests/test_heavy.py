"""Bounded summaries as custom stream state: bounds, restart, timers."""

from __future__ import annotations

import os
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventide.operators import quality
from eventide.functions.parse import parse_events
from eventide.sources.events import event_stream
from eventide.streaming import heavy
from test_repair import _files
from test_streaming import _jsonl


@pytest.fixture(autouse=True)
def store(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    heavy.needs(spark)
    yield
    if before:
        spark.conf.set(key, before)


def test_folded_summaries_keep_their_bounds():
    import random
    r = random.Random(4)
    items = [min(int(r.paretovariate(0.6)), 5000) for _ in range(20_000)]
    counts, lost = pd.Series(dtype="int64"), 0
    for k in range(0, len(items), 700):
        counts, off = heavy.folded(counts, pd.Series(items[k:k + 700]).value_counts(), 50)
        lost += off
        assert len(counts) <= 50
    assert lost <= len(items) / 51
    for item, n in Counter(items).items():
        assert counts.get(item, 0) <= n <= counts.get(item, 0) + lost


def _start(spark, land, root, shards, counters):
    valid = quality.validate(parse_events(event_stream(spark, "text", land, maxFilesPerTrigger=1)))[0]
    q = (heavy.summaries(valid.withWatermark("created_at", "10 minutes"), "1 hour", shards, counters)
         .writeStream.outputMode("append").option("checkpointLocation", os.path.join(root, "ck"))
         .format("parquet").option("path", os.path.join(root, "out")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(heavy.SUMMARY).parquet(os.path.join(root, "out"))


def test_stream_finds_heavy_repositories_across_a_restart(spark, scratch):
    from conftest import event
    import random
    r = random.Random(5)
    batches, truth = [], Counter()
    for b in range(6):
        evs = []
        for k in range(120):
            repo = 1 if r.random() < 0.34 else r.randrange(2, 150)
            hour, minute = 10 + b // 2, (b % 2) * 30 + k // 5
            evs.append(event(id=f"{b}-{k}", repo__id=repo, created_at=f"2024-01-02T{hour}:{minute:02}:00Z"))
            truth[hour, repo] += 1
        batches.append(evs)
    land = os.path.join(scratch, "land")
    _files(land, batches[:3])                        # stops in the middle of the second hour
    first = _start(spark, land, scratch, 4, 20)
    assert {x.window_start for x in first.select("window_start").distinct().collect()} == {
        1704189600000000}                            # 10:00, closed by the watermark
    _files(land, batches)                            # the same names, and the later ones
    closer = [event(id="end", created_at="2024-01-02T20:00:00Z")]
    _jsonl(land, "z.json", closer)                   # the youngest file
    out = _start(spark, land, scratch, 4, 20)
    found = {(x.window_start.hour, x.repo_id): x for x in heavy.heavy(out, 0.1).withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz")).collect()}
    for hour in (10, 11, 12):
        total = sum(n for (h, _), n in truth.items() if h == hour)
        for (h, repo), n in truth.items():
            if h == hour and n >= 0.1 * total:
                x = found[hour, repo]
                assert x.at_least <= n <= x.at_most and x.window_events == total
        assert (hour, 1) in found
    assert all(x.at_most - x.at_least <= x.window_events / 21 for x in found.values())
    per_shard = out.groupBy("window_start", "shard").count()
    assert per_shard.agg(F.max("count")).first()[0] <= 20
    once = out.groupBy("window_start", "shard", "repo_id").count()
    assert once.agg(F.max("count")).first()[0] == 1
