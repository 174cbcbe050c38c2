from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import STAR_EVENT, event, parsed
from eventide.functions.timefilters import resolve_range
from eventide.operators import maintenance, metrics
from eventide.plans import panels, reports
from eventide.schema import REPOSITORY_METRICS_TABLE
from eventide.streaming import sinks

AS_OF = "2024-01-31 00:00:00"


def _ts(s):
    return dt.datetime.fromisoformat(s)


def _rm(spark, rows):
    full = [(rid, name, _ts(ws), _ts(ws) + dt.timedelta(hours=1), n, s, 0, 0, 0)
            for rid, name, ws, n, s in rows]
    return spark.createDataFrame(full, REPOSITORY_METRICS_TABLE)


def test_top_repositories_tie_break_and_range(spark):
    m = _rm(spark, [
        (3, "c", "2024-01-30 10:00:00", 5, 1),
        (1, "a", "2024-01-30 11:00:00", 5, 0),
        (2, "b", "2024-01-30 12:00:00", 5, 2),
        (4, "d", "2024-01-29 23:45:00", 50, 0),   # before the 24 h range
    ])
    out = reports.top_repositories(m, AS_OF, k=2).collect()
    assert [(r.repo_id, r.total_events) for r in out] == [(1, 5), (2, 5)]


def test_overlap_tile_gives_true_counts(spark):
    ev = parsed(spark, [event(created_at="2024-01-30T10:20:00Z")])
    m = metrics.repository_metrics(ev)
    summed = reports.top_repositories(m, AS_OF).collect()[0].total_events
    tiled = reports.top_repositories(m, AS_OF, overlap="tile").collect()[0].total_events
    assert (summed, tiled) == (4, 1)


def test_event_type_summary_share(spark):
    e = spark.createDataFrame(
        [("PushEvent", _ts("2024-01-30 10:00:00"), _ts("2024-01-30 11:00:00"), 2),
         ("WatchEvent", _ts("2024-01-30 10:00:00"), _ts("2024-01-30 11:00:00"), 1)],
        "event_type string, window_start timestamp, window_end timestamp, event_count bigint")
    out = {r.event_type: r.percentage for r in reports.event_type_summary(e, AS_OF).collect()}
    assert out == {"PushEvent": 66.67, "WatchEvent": 33.33}


def test_aggregated_metrics_by_hour(spark):
    m = _rm(spark, [(1, "a", "2024-01-30 10:00:00", 2, 1), (1, "a", "2024-01-30 10:15:00", 3, 0),
                    (2, "b", "2024-01-30 10:30:00", 1, 0)])
    r = reports.aggregated_metrics(m).collect()[0]
    assert (r.total_events, r.unique_repos, r.total_stars) == (6, 2, 1)


def test_panels(spark):
    m = _rm(spark, [(i, f"r{i}", "2024-01-30 10:00:00", 100 - i, 0) for i in range(15)])
    act = panels.repository_activity(m, "2024-01-30 00:00:00", "2024-01-31 00:00:00", AS_OF)
    assert act.count() == panels.TOP_SERIES
    stats = panels.series_stats(act).collect()[0]
    assert (stats["max"], stats["sum"]) == (100, sum(100 - i for i in range(10)))
    stars = panels.repository_stars(m, "2024-01-30 11:00:00", "2024-01-31 00:00:00")
    assert stars.count() == 0   # window_end = 11:00 is not strictly inside
    assert panels.top_repositories(m, AS_OF).columns[0] == "repo_name"


def test_resolve_range():
    frm, to = resolve_range("now-7d", dt.datetime(2024, 1, 31))
    assert (frm, to) == (dt.datetime(2024, 1, 24), dt.datetime(2024, 1, 31))


def test_retention(spark):
    m = _rm(spark, [(1, "a", "2024-01-01 10:00:00", 1, 0), (1, "a", "2024-01-20 10:00:00", 1, 0)])
    daily = m.withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 1 DAY"))
    kept = maintenance.retain_tiered(m.unionByName(daily), as_of="2024-02-15 00:00:00")
    assert kept.count() == 3    # the old hourly row is dropped, both daily rows stay
    ev = metrics.raw_events(parsed(spark, [STAR_EVENT]))
    assert maintenance.retain(ev, "created_at", 7, "2024-01-05 00:00:00").count() == 1
    assert maintenance.retain(ev, "created_at", 7, "2024-01-20 00:00:00").count() == 0
    fc = maintenance.flow_check(ev).collect()[0]
    assert (fc.event_count, fc.status) == (1, "flowing")


def test_arrays_to_text_and_keyed_json(spark):
    df = spark.createDataFrame([("1", ["a", None, "b"], None)],
                               "id string, langs array<string>, repo_name string")
    assert sinks.arrays_to_text(df).collect()[0].langs == "a,b"
    rec = sinks.to_keyed_json(df).collect()[0]
    assert rec.key is None and '"repo_name":null' in rec.value


def test_keyed_append_replay_is_noop(spark):
    m = _rm(spark, [(1, "a", "2024-01-30 10:00:00", 1, 0), (2, "b", "2024-01-30 10:00:00", 1, 0)])
    key = list(sinks.TABLE_KEYS["repository_metrics"])
    assert sinks.keyed_append(m, m, key).count() == 0
    new = _rm(spark, [(3, "c", "2024-01-30 10:00:00", 1, 0), (1, "a", "2024-01-30 10:00:00", 9, 0)])
    assert [r.repo_id for r in sinks.keyed_append(new, m, key).collect()] == [3]


def test_lake_writer_replay_same_batch(spark, scratch):
    path = os.path.join(scratch, "rm")
    write = sinks.lake_batch_writer(path, "repository_metrics")
    m = _rm(spark, [(1, "a", "2024-01-30 10:00:00", 1, 0), (2, "b", "2024-01-31 10:00:00", 1, 0)])
    write(m, 0)
    write(m, 0)          # replay of batch 0 after a failure
    write(m.limit(0), 1)  # empty batch: nothing written
    write(m, 2)          # the same rows in another batch: keys are present
    out = spark.read.parquet(path)
    assert out.count() == 2
    assert sorted(r.window_date.isoformat() for r in out.collect()) == ["2024-01-30", "2024-01-31"]


def test_time_ranges_cover_the_span_once():
    lo, hi = _ts("2024-01-30 00:00:00"), _ts("2024-01-30 08:00:00")
    parts = sinks._time_ranges("window_start", lo, hi)
    assert len(parts) == 8
    assert parts[0].startswith("window_start >= '2024-01-30 00:00:00'")
    assert parts[-1].endswith("<= '2024-01-30 08:00:00'")
    assert all("< '" in p for p in parts[:-1])


def test_jdbc_writer_shapes_and_propagates(spark):
    seen = []
    write = sinks.jdbc_batch_writer("t", "jdbc:none", {}, writer=lambda df: seen.append(df.collect()))
    df = spark.createDataFrame([("u", ["PushEvent", "WatchEvent"])], "username string, types array<string>")
    write(df, 0)
    write(df.limit(0), 1)
    assert len(seen) == 1 and seen[0][0].types == "PushEvent,WatchEvent"

    def boom(_):
        raise RuntimeError("database down")
    failing = sinks.jdbc_batch_writer("t", "jdbc:none", {}, writer=boom)
    try:
        failing(df, 2)
        raise AssertionError("error was swallowed")
    except RuntimeError as e:
        assert "database down" in str(e)


def test_jdbc_writer_skips_existing_keys(spark):
    have = _rm(spark, [(1, "a", "2024-01-30 10:00:00", 1, 0), (9, "z", "2024-01-01 10:00:00", 1, 0)])
    seen = []
    write = sinks.jdbc_batch_writer(
        "repository_metrics", "jdbc:none", {}, key=sinks.TABLE_KEYS["repository_metrics"],
        writer=lambda df: seen.append(sorted(r.repo_id for r in df.collect())),
        reader=lambda: have)
    batch = _rm(spark, [(1, "a", "2024-01-30 10:00:00", 5, 0), (2, "b", "2024-01-30 10:15:00", 1, 0)])
    write(batch, 3)
    assert seen == [[2]]
