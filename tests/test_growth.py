"""What one task gets must not grow with the input: layout of tables and landings."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from eventide import lake
from eventide.plans import catalog, repair
from eventide.sources.landing import land_in_time_order, landed_files


def _files(path):
    return [f for _, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]


def _hours(spark, n, day="2024-01-02", hours=1):
    start = F.timestamp_seconds(F.unix_timestamp(F.lit(f"{day} 00:00:00")) + F.col("id") % 20 * 900)
    return spark.range(n).select(
        (F.col("id") % 7).alias("repo_id"), F.concat(F.lit("o/"), "id").alias("repo_name"),
        start.alias("window_start"), (start + F.make_interval(hours=F.lit(hours))).alias("window_end"),
        *[F.lit(1).cast("long").alias(c)
          for c in ("event_count", "stars", "forks", "pull_requests", "issues")])


def test_insert_if_absent_is_not_squeezed_into_the_writing_task(spark, scratch):
    """few rows are written by one task, behind a shuffle of what compares them."""
    path = os.path.join(scratch, "repository_metrics")
    lake.append(_hours(spark, 200), path, "repository_metrics", "a")
    batch = lake.dated(_hours(spark, 400))
    new = lake.absent(batch, lake.read(spark, path), list(lake.TABLE_KEYS["repository_metrics"]))
    plan = lake.clustered(new, "repository_metrics", 400)._jdf.queryExecution().toString()
    assert "Coalesce" not in plan and "SinglePartition" in plan
    lake.append(_hours(spark, 400), path, "repository_metrics", "b")
    assert lake.read(spark, path).groupBy("batch_id").count().orderBy("batch_id").collect() == [
        ("a", 200), ("b", 200)]


def test_rows_of_one_date_are_split_by_key(spark, scratch, monkeypatch):
    """rejected records have no entity and share the day of the build."""
    monkeypatch.setattr(lake, "ROWS_PER_FILE", 100)
    path = os.path.join(scratch, "rejected_events")
    bad = spark.range(400).select(
        F.col("id").cast("string").alias("id"), F.lit("unknown").alias("type"),
        F.lit("repo.name").alias("errors"), F.lit(None).cast("string").alias("event_key"),
        F.sha2(F.col("id").cast("string"), 256).alias("record_id"),
        F.lit("2024-01-02 00:00:00").cast("timestamp").alias("created_at"))
    lake.append(bad, path, "rejected_events", "a", any_date=True)
    lake.append(bad, path, "rejected_events", "b", any_date=True)
    assert lake.read(spark, path).count() == 400
    sizes = [r[0] for r in lake.read(spark, path).groupBy(F.input_file_name()).agg(
        F.count("*")).select("count(1)").collect()]
    assert len(sizes) >= 4 and max(sizes) <= 200


def test_expired_leaf_is_rewritten_by_many_tasks(spark, scratch, monkeypatch):
    """a leaf that holds rows to keep and rows to drop."""
    path = os.path.join(scratch, "repository_metrics")
    lake.append(_hours(spark, 600).unionByName(_hours(spark, 200, hours=24)), path,
                "repository_metrics", "a")
    monkeypatch.setattr(lake, "ROWS_PER_FILE", 50)
    gone = F.unix_timestamp("window_end") - F.unix_timestamp("window_start") == 3600
    assert lake.expire(spark, path, "repository_metrics", gone, dt.date(2024, 1, 2)) == (0, 1)
    assert lake.read(spark, path).count() == 200
    assert lake.read(spark, path).where(gone).isEmpty()
    assert len(_files(path)) >= 4


def test_late_marks_are_not_found_by_one_task(spark, scratch, monkeypatch):
    """F2: a micro-batch's distinct windows are found by the batch's own tasks."""
    plans = []
    monkeypatch.setattr(lake, "write", lambda df, *_: plans.append(
        df._jdf.queryExecution().toString()))
    windows = _hours(spark, 100).select("window_start", "window_end").distinct()
    lake.append(windows, os.path.join(scratch, "dirty_windows"), "dirty_windows", "a", stored=True)
    assert len(plans) == 1 and "Coalesce" not in plans[0]


def test_upsert_takes_tasks_by_its_rows(spark, scratch, monkeypatch):
    """F2: a micro-batch and what is stored meet in more tasks than the session's
    partitions, where their rows need them."""
    monkeypatch.setattr(lake, "ROWS_PER_FILE", 20)
    path = os.path.join(scratch, "repository_metrics")
    lake.append(_hours(spark, 200), path, "repository_metrics", "a")
    lake.append(_hours(spark, 300), path, "repository_metrics", "b")
    again = _hours(spark, 200).where("repo_id < 3")               # copies, as a lost repair leaves them
    lake.write(lake.dated(again), path, "repository_metrics", "c")
    seen = []
    merged = lake._replaced

    def watch(*args):
        out = merged(*args)
        seen.append((out.rdd.getNumPartitions(), out._jdf.queryExecution().toString()))
        return out
    monkeypatch.setattr(lake, "_replaced", watch)
    new = _hours(spark, 250).where("id >= 100").withColumn("stars", F.lit(9).cast("long"))
    lake.upsert(new, path, "repository_metrics", "d")
    stored = 300 + again.count()
    assert seen[0][0] == -(-(150 + stored) // 20) and "Join" not in seen[0][1]
    rows = lake.read(spark, path)
    assert rows.groupBy("batch_id", "stars").count().orderBy("stars").collect() == [
        ("d", 1, 150), ("d", 9, 150)]
    assert rows.select("repo_id", "repo_name", "window_start").distinct().count() == 300


def test_upsert_of_null_keys_and_repeated_rows(spark, scratch):
    """A null key is a key; a batch's own copies stay, as a stored key does once."""
    path = os.path.join(scratch, "repository_metrics")
    name = F.when(F.col("repo_id") != 2, F.col("repo_name"))
    old = _hours(spark, 21).withColumn("repo_name", name)
    lake.append(old, path, "repository_metrics", "a")
    lake.write(lake.dated(old), path, "repository_metrics", "b")
    new = old.where("repo_id = 2").withColumn("stars", F.lit(9).cast("long"))
    lake.upsert(new.unionByName(new), path, "repository_metrics", "c")
    got = lake.read(spark, path)
    assert got.where("repo_id = 2").groupBy("stars").count().collect() == [(9, 6)]
    assert got.where("repo_id <> 2").groupBy("stars").count().collect() == [(1, 18)]


def test_repair_aggregates_in_tasks_by_rows(spark, monkeypatch):
    """what a task aggregates follows from the rows, not from the files."""
    monkeypatch.setattr(repair, "ROWS_PER_TASK", 50)
    raw = spark.range(1000).select(F.col("id").cast("string").alias("id")).coalesce(1)
    spread = repair._spread(raw)
    assert spread.rdd.getNumPartitions() == 20 and spread.distinct().count() == 1000


def _records(spark, n):
    return spark.range(n).select(
        F.lit("k").alias("key"), F.col("id").cast("string").alias("value"),
        F.timestamp_seconds(F.col("id")).alias("ts"))


def test_time_range_is_landed_in_as_many_files_as_it_needs(spark, scratch, monkeypatch):
    """a micro-batch is a time range still, of files that several tasks read."""
    monkeypatch.setattr(catalog, "ROWS_PER_LANDED_FILE", 100)
    land = catalog._land_records(spark, _records(spark, 1500), "ts", scratch)
    files = landed_files(spark, land)
    assert 3 * catalog.STREAM_FILES - 2 <= len(files) <= 3 * catalog.STREAM_FILES
    stamps = [os.path.getmtime(f.removeprefix("file:")) for f in files]
    assert stamps == sorted(set(stamps))
    got = []

    def take(df, _):
        got.append([int(r.value) for r in df.collect()])
    catalog._landing_stream(spark, land).writeStream.foreachBatch(take).trigger(
        availableNow=True).option("checkpointLocation", os.path.join(scratch, "ck")).start().awaitTermination()
    assert len(got) <= catalog.STREAM_FILES
    assert sorted(x for b in got for x in b) == list(range(1500))
    assert all(max(a) < min(b) for a, b in zip(got, got[1:]))


def test_small_landing_stays_a_file_per_time_range(spark, scratch):
    land = os.path.join(scratch, "land")
    land_in_time_order(spark, _records(spark, 60), "ts", land, files=3)
    assert len(landed_files(spark, land)) == 3
    again = catalog._land_records(spark, _records(spark, 60), "ts", os.path.join(scratch, "b"))
    assert len(landed_files(spark, again)) <= catalog.STREAM_FILES


def test_ingest_scans_and_parses_its_records_once(spark, scratch):
    """valid and rejected records come out of one parse of the source."""
    from conftest import PUSH_EVENT, event, records
    from eventide.schema import CLEAN_EVENT
    from eventide.sources.events import event_stream
    from eventide.streaming import runner
    land, clean = os.path.join(scratch, "land"), os.path.join(scratch, "clean")
    records(spark, [PUSH_EVENT, event(id="2", type="OddEvent"), event(PUSH_EVENT, id="3", repo__name=None),
                    '{"id": "4", "ty'], "k").write.parquet(land)
    q = runner.start_ingest(event_stream(spark, "parquet", land), clean, os.path.join(scratch, "ck"),
                            {"availableNow": True})
    q.awaitTermination()
    assert q._jsq.explainInternal(False).count("FileScan") == 1
    seen = [p["observedMetrics"]["event_quality"] for p in q.recentProgress if p["observedMetrics"]]
    assert sum(m["events"] for m in seen) == 2 and sum(m["unknown_types"] for m in seen) == 1
    rows = {r.id: r for r in spark.read.schema(CLEAN_EVENT).parquet(clean).collect()}
    assert set(rows) == {"91002", "2", "3", None}
    assert sorted(rows["91002"].languages) == ["Elixir", "Kotlin"] and rows["91002"].record_id is None
    assert rows["91002"].errors is None and rows["2"].languages == []
    assert rows["3"].errors == "repo.name" and rows["3"].languages is None and rows["3"].record_id
    assert rows[None].errors.startswith("id,type,actor.id")
