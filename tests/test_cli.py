"""The command line: stream job, batch backfill, retention."""

from __future__ import annotations

import os

from conftest import SF_SMALL
from eventide.__main__ import main
from eventide.plans import pipeline
from eventide.sources.adapter import landed_records
from eventide.sources.events import metric_table
from eventide.sources.landing import land_in_time_order


def test_stream_build_retain(spark, scratch):
    land = os.path.join(scratch, "land")
    land_in_time_order(spark, landed_records(pipeline.table(spark, SF_SMALL, "events"), keep=("ts",)),
                       "ts", land, files=3)
    lake_s, lake_b = os.path.join(scratch, "lake_s"), os.path.join(scratch, "lake_b")
    main(["stream", "--source", "parquet", "--path", land, "--option", "maxFilesPerTrigger=1",
          "--lake", lake_s, "--checkpoints", os.path.join(scratch, "ck"), "--available-now",
          "--tables", "repository_metrics"])
    main(["build", "--source", "parquet", "--path", land, "--lake", lake_b,
          "--tables", "repository_metrics"])
    streamed = metric_table(spark, lake_s, "repository_metrics").drop("window_date", "batch_id")
    built = metric_table(spark, lake_b, "repository_metrics").drop("window_date", "batch_id")
    streamed_count = streamed.count()
    assert streamed_count > 0 and streamed.exceptAll(built).count() == 0
    assert built.count() == 3970

    main(["retain", "--lake", lake_b, "--tier", "1 hour=10", "--as-of", "2024-01-31",
          "--tables", "repository_metrics"])
    left = metric_table(spark, lake_b, "repository_metrics")
    # by window_end: windows begun the evening before and ended after the cut stay
    assert str(left.agg({"window_end": "min"}).collect()[0][0]) >= "2024-01-21 00:00:00"
    assert left.count() == built_after(spark, land, "2024-01-21 00:00:00")
    main(["compact", "--lake", lake_s, "--tables", "repository_metrics"])
    assert metric_table(spark, lake_s, "repository_metrics").count() == streamed_count


def test_stream_with_marks_then_repair(spark, scratch, capsys):
    from conftest import event
    from test_repair import _files
    land, root = os.path.join(scratch, "land"), os.path.join(scratch, "lake")
    _files(land, [[event(id="1", created_at="2024-01-03T12:00:00Z")],
                  [event(id="2", created_at="2024-01-02T10:00:00Z")]])
    main(["stream", "--source", "text", "--path", land, "--option", "maxFilesPerTrigger=1", "--lake",
          root, "--checkpoints", os.path.join(scratch, "ck"), "--available-now", "--mark-late",
          "--tables", "events", "session_activity", "repository_metrics"])
    main(["repair", "--lake", root])
    main(["retain", "--lake", root, "--as-of", "2024-01-03", "--raw-days", "0",
          "--tables", "session_activity"])
    said = capsys.readouterr().out
    assert "windows recomputed" in said and "session_activity: " in said
    left = metric_table(spark, root, "repository_metrics")
    assert left.agg({"event_count": "sum"}).collect()[0][0] == 4      # the late event's windows


def built_after(spark, land, ts):
    from eventide.functions.parse import parse_events
    from eventide.operators import metrics
    from eventide.sources.events import event_batch
    ev = pipeline.clean(parse_events(event_batch(spark, "parquet", land)))
    return metrics.repository_metrics(ev).filter(f"window_end >= '{ts}'").count()


def test_build_writes_rejected(spark, scratch):
    land, lake = os.path.join(scratch, "jsonl"), os.path.join(scratch, "lake")
    landed_records(pipeline.table(spark, SF_SMALL, "events"), defects=True).select(
        "value").write.text(land)
    main(["build", "--source", "text", "--path", land, "--lake", lake, "--tables", "events"])
    assert metric_table(spark, lake, "rejected_events").count() == 100
    assert metric_table(spark, lake, "events").count() == 900


def test_build_from_json_lines(spark, scratch):
    from pyspark.sql import functions as F
    from eventide.operators import metrics

    land = os.path.join(scratch, "jsonl")
    recs = landed_records(pipeline.table(spark, SF_SMALL, "events"))
    recs.select("value").write.text(land)          # one JSON event per line, no key
    lake = os.path.join(scratch, "lake")
    main(["build", "--source", "text", "--path", land, "--lake", lake,
          "--tables", "events", "language_trends"])
    assert metric_table(spark, lake, "events").count() == 1000
    built = metric_table(spark, lake, "language_trends").drop("window_date", "batch_id")
    direct = metrics.language_trends(pipeline.events(spark, SF_SMALL))
    assert built.exceptAll(direct).count() == 0 and direct.exceptAll(built).count() == 0
    assert built.agg(F.sum("event_count")).collect()[0][0] > 0
