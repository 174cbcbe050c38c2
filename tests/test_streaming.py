"""Batch/stream parity, restart from checkpoint, and replay safety."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from eventide.plans import pipeline
from eventide.sources.adapter import landed_records
from eventide.sources.events import event_stream, metric_table
from eventide.sources.landing import land_in_time_order
from eventide.streaming import runner

TABLES = ["events", "repository_metrics", "event_type_distribution", "user_activity",
          "language_trends"]


def _run(spark, land, lake, ckpt):
    qs = runner.run_all(spark, event_stream(spark, "parquet", land, maxFilesPerTrigger=1),
                        lake, ckpt, trigger={"availableNow": True})
    runner.await_all(spark, qs, bounded=True)
    return qs


def _table(spark, lake, name):
    return metric_table(spark, lake, name).drop("window_date", "batch_id")


def test_stream_matches_batch_on_closed_windows(spark, scratch):
    ev = pipeline.table(spark, SF_SMALL, "events")
    early = ev.filter(F.col("ts") < "2024-01-21")
    late = ev.filter(F.col("ts") >= "2024-01-21")
    land, lake, ckpt = (os.path.join(scratch, d) for d in ("land", "lake", "ckpt"))
    land_in_time_order(spark, landed_records(early, keep=("ts",)), "ts",
                       os.path.join(land, "a"), files=3)
    src = os.path.join(land, "a")
    _run(spark, src, lake, ckpt)
    first = _table(spark, lake, "repository_metrics").count()
    assert first > 0

    # restart on the same checkpoints with nothing new: no row is written twice
    _run(spark, src, lake, ckpt)
    assert _table(spark, lake, "repository_metrics").count() == first

    # new files arrive; the restarted queries resume from their checkpoints
    land_in_time_order(spark, landed_records(late, keep=("ts",)), "ts",
                       os.path.join(scratch, "late"), files=2)
    for f in sorted(os.listdir(os.path.join(scratch, "late"))):
        if f.endswith(".parquet"):
            st = os.stat(os.path.join(scratch, "late", f))
            os.link(os.path.join(scratch, "late", f), os.path.join(src, "late_" + f))
            os.utime(os.path.join(src, "late_" + f), ns=(st.st_atime_ns, st.st_mtime_ns))
    qs = _run(spark, src, lake, ckpt)
    for q in qs:
        for op in (q.lastProgress or {}).get("stateOperators", []):
            assert op.get("numRowsDroppedByWatermark", 0) == 0

    batch_ev = pipeline.events(spark, SF_SMALL)
    raw = _table(spark, lake, "events")
    assert raw.count() == batch_ev.count()
    # each query closes windows by its own watermark: the latest event time it
    # saw minus the delay (a query that reads only events with languages sees
    # fewer of them)
    marks = {q.name: q.lastProgress["eventTime"]["watermark"] for q in qs
             if q.lastProgress and "watermark" in q.lastProgress.get("eventTime", {})}
    max_ts = batch_ev.agg(F.max("created_at")).collect()[0][0]
    import datetime as dt
    assert marks["repository_metrics"].startswith(
        (max_ts - dt.timedelta(minutes=10)).strftime("%Y-%m-%dT%H:%M:%S"))
    from eventide.operators import metrics
    for name in TABLES[1:]:
        streamed = _table(spark, lake, name)
        batch = metrics.METRIC_TABLES[name](batch_ev)
        closed = batch.filter(F.col("window_end") <= F.to_timestamp(F.lit(marks[name])))
        assert streamed.exceptAll(batch).count() == 0, name
        assert closed.exceptAll(streamed).count() == 0, name


def test_late_event_in_raw_table_not_in_closed_windows(spark, scratch):
    import json
    import time
    from conftest import event
    from eventide.operators import metrics

    land = os.path.join(scratch, "land")
    os.makedirs(land)
    # Spark filters late rows with the watermark of the previous batch, so the
    # late event arrives two files after the one that moved the watermark
    batches = [
        [event(id="1", created_at="2024-01-02T10:00:00Z"),
         event(id="2", created_at="2024-01-02T12:00:00Z")],
        [event(id="4", created_at="2024-01-02T12:05:00Z"),
         event(id="2", created_at="2024-01-02T12:00:00Z"),          # a re-sent copy
         event(id="6", created_at="garbage")],                      # rejected
        [event(id="3", created_at="2024-01-02T09:00:00Z"),          # older than the watermark
         event(id="5", created_at="2024-01-02T15:00:00Z", type="BrandNewEvent")],
    ]
    now = time.time() - 100
    for i, evs in enumerate(batches):
        f = os.path.join(land, f"part_{i}.json")
        with open(f, "w") as fh:
            for e in evs:
                fh.write(json.dumps(e) + "\n")
        os.utime(f, (now + 10 * i, now + 10 * i))
    lake, ckpt = os.path.join(scratch, "lake"), os.path.join(scratch, "ckpt")
    qs = runner.run_all(spark, event_stream(spark, "text", land, maxFilesPerTrigger=1), lake, ckpt,
                        trigger={"availableNow": True}, tables=["events", "repository_metrics"])
    runner.await_all(spark, qs, bounded=True)
    raw = sorted(r.id for r in _table(spark, lake, "events").collect())
    assert raw == ["1", "2", "3", "4", "5"]     # late "3" is kept, the copy of "2" is not
    rej = [(r.id, r.errors) for r in metric_table(spark, lake, "rejected_events").collect()]
    assert rej == [("6", "created_at")]
    assert not any(p.get("stateOperators") for q in qs if q.name in ("clean_events", "events")
                   for p in q.recentProgress)
    seen = [p["observedMetrics"]["event_quality"] for q in qs if q.name == "clean_events"
            for p in q.recentProgress if "event_quality" in p.get("observedMetrics", {})]
    assert sum(m["unknown_types"] for m in seen) == 1

    # file by file, the windowed query has a watermark for "3" to be late for;
    # the raw table still takes it
    direct = os.path.join(scratch, "direct")
    qs = runner.run_all(spark, event_stream(spark, "text", land, maxFilesPerTrigger=1), direct,
                        os.path.join(scratch, "ck2"), trigger={"availableNow": True},
                        tables=["events", "repository_metrics"], staged=False)
    runner.await_all(spark, qs, bounded=True)
    assert sorted(r.id for r in _table(spark, direct, "events").collect()) == raw
    assert _table(spark, direct, "repository_metrics").filter(
        "window_start < '2024-01-02 09:00:00'").count() == 0
    progress = [p for q in qs if q.name == "repository_metrics" for p in q.recentProgress]
    assert sum(op.get("numRowsDroppedByWatermark", 0)
               for p in progress for op in p.get("stateOperators", [])) >= 1

    # the same events in batch keep the late one
    from conftest import parsed
    from eventide.operators import quality
    batch = quality.dedup(quality.validate(parsed(spark, [e for b in batches for e in b]))[0])
    assert batch.count() == 5
    assert metrics.repository_metrics(batch).filter("window_start <= '2024-01-02 09:00:00'").count() == 4


def test_sql_over_registered_stream_and_landing_retention(spark, scratch):
    import json
    import time
    from conftest import STAR_EVENT
    from eventide.streaming import sinks

    land = os.path.join(scratch, "land")
    os.makedirs(land)
    for i in range(3):
        f = os.path.join(land, f"e{i}.json")
        with open(f, "w") as fh:
            fh.write(json.dumps({**STAR_EVENT, "id": str(i)}) + "\n")
        age = 48 * 3600 if i == 0 else 0
        os.utime(f, (time.time() - age, time.time() - age))
    ev, _ = runner.prepare(event_stream(spark, "text", land))
    runner.register(ev, "activity_events_test")
    q = spark.sql("SELECT type, count(*) AS n FROM activity_events_test GROUP BY type")
    assert q.isStreaming
    out = os.path.join(scratch, "counts")
    sink = lambda df, _id: df.write.mode("overwrite").parquet(out)
    query = (q.writeStream.outputMode("complete").foreachBatch(sink)
              .option("checkpointLocation", os.path.join(scratch, "ck"))
              .trigger(availableNow=True).start())
    query.awaitTermination()
    assert [(r.type, r.n) for r in spark.read.parquet(out).collect()] == [("WatchEvent", 3)]
    assert sinks.expire_landed_files(spark, land, 24) == 1
    assert sorted(os.listdir(land)) == ["e1.json", "e2.json"]


def test_direct_topology_matches_staged(spark, scratch):
    ev = pipeline.table(spark, SF_SMALL, "events")
    land = os.path.join(scratch, "land")
    land_in_time_order(spark, landed_records(ev, keep=("ts",)), "ts", land, files=3)
    out = {}
    for staged in (True, False):
        lake = os.path.join(scratch, f"lake_{staged}")
        qs = runner.run_all(spark, event_stream(spark, "parquet", land, maxFilesPerTrigger=1),
                            lake, os.path.join(scratch, f"ck_{staged}"),
                            trigger={"availableNow": True}, tables=["repository_metrics"],
                            with_rejected=False, staged=staged)
        runner.await_all(spark, qs, bounded=True)
        out[staged] = _table(spark, lake, "repository_metrics")
    assert out[True].count() > 3900
    assert out[True].exceptAll(out[False]).count() == 0
    assert out[False].exceptAll(out[True]).count() == 0


def _jsonl(land, name, evs):
    import json
    os.makedirs(land, exist_ok=True)
    with open(os.path.join(land, name), "w") as fh:
        for e in evs:
            fh.write(json.dumps(e) + "\n")


def test_new_checkpoint_keeps_earlier_rows(spark, scratch):
    from conftest import event
    lake = os.path.join(scratch, "lake")
    for k, ids in enumerate((["a", "b"], ["b", "c"])):
        land = os.path.join(scratch, f"land{k}")
        _jsonl(land, "e.json", [event(id=i) for i in ids])
        qs = runner.run_all(spark, event_stream(spark, "text", land), lake,
                            os.path.join(scratch, f"ck{k}"),
                            trigger={"availableNow": True}, tables=["events"],
                            with_rejected=False, staged=False)
        runner.await_all(spark, qs, bounded=True)
    assert sorted(r.id for r in _table(spark, lake, "events").collect()) == ["a", "b", "c"]
    # batch 0 of either query has a leaf of its own
    assert len({r.batch_id for r in metric_table(spark, lake, "events").collect()}) == 2


def test_update_mode_upserts_open_windows(spark, scratch):
    from conftest import event
    land = os.path.join(scratch, "land")
    lake, ckpt = os.path.join(scratch, "lake"), os.path.join(scratch, "ck")

    def run():
        qs = runner.run_all(spark, event_stream(spark, "text", land), lake, ckpt,
                            trigger={"availableNow": True}, tables=["event_type_distribution"],
                            with_rejected=False, mode="update")
        runner.await_all(spark, qs, bounded=True)
        rows = _table(spark, lake, "event_type_distribution").collect()
        assert len({(r.event_type, r.window_start) for r in rows}) == len(rows)
        return max(r.event_count for r in rows), len(rows)

    _jsonl(land, "1.json", [event(id="1", created_at="2024-01-02T10:00:00Z")])
    assert run() == (1, 4)                      # open windows are served
    _jsonl(land, "2.json", [event(id="2", created_at="2024-01-02T10:01:00Z"),
                            event(id="1", created_at="2024-01-02T10:00:00Z")])
    assert run() == (2, 4)                      # and replaced by key


def test_stop_all_when_one_query_fails(spark, scratch):
    import pytest
    from conftest import event
    land = os.path.join(scratch, "land")
    _jsonl(land, "1.json", [event(id="1")])

    def fail(table, df):
        raise RuntimeError("database down")
    qs = runner.run_all(spark, event_stream(spark, "text", land), os.path.join(scratch, "lake"),
                        os.path.join(scratch, "ck"), tables=["events"], with_rejected=False,
                        sink="jdbc", sink_options={
                            "writer": fail, "reader": lambda t: spark.createDataFrame(
                                [], "id string, created_at timestamp")})
    with pytest.raises(Exception, match="database down"):
        runner.await_all(spark, qs, bounded=False, timeout=60)
    assert not any(q.isActive for q in qs)


def test_json_and_jdbc_sinks_from_the_job(spark, scratch):
    import json
    from conftest import PUSH_EVENT, event
    land, lake = os.path.join(scratch, "land"), os.path.join(scratch, "lake")
    _jsonl(land, "1.json", [event(id="1"), PUSH_EVENT])
    qs = runner.run_all(spark, event_stream(spark, "text", land), lake,
                        os.path.join(scratch, "ck"), trigger={"availableNow": True},
                        tables=["enriched_events"], with_rejected=False, sink="json")
    runner.await_all(spark, qs, bounded=True)
    out = spark.read.parquet(os.path.join(lake, "_json", "enriched_events")).collect()
    by_id = {json.loads(r.value)["id"]: (r.key, json.loads(r.value)["languages"]) for r in out}
    assert by_id == {"1": ("fjord/lantern", []), "91002": ("fjord/lantern", ["Elixir", "Kotlin"])}

    seen = []
    qs = runner.run_all(spark, event_stream(spark, "text", land), os.path.join(scratch, "lake2"),
                        os.path.join(scratch, "ck2"), trigger={"availableNow": True},
                        tables=["events"], with_rejected=False, sink="jdbc", sink_options={
                            "writer": lambda t, df: seen.append((t, df.count())),
                            "reader": lambda t: spark.createDataFrame(
                                [], "id string, created_at timestamp")})
    runner.await_all(spark, qs, bounded=True)
    assert seen == [("events", 2)]
