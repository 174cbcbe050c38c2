"""Batch build of the served tables and reports over them."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from eventide.plans import catalog, pipeline, reports, tables
from eventide.operators import metrics
from eventide.sources.events import metric_table


def test_build_tables_and_pruned_reports(spark, scratch):
    ev = pipeline.events(spark, SF_SMALL)
    paths = tables.build_tables(spark, ev, scratch)
    assert set(paths) == {"events", "repository_metrics", "event_type_distribution",
                          "user_activity", "language_trends"}
    assert any(d.startswith("window_date=") for d in os.listdir(paths["repository_metrics"]))

    m = metric_table(spark, scratch, "repository_metrics")
    assert m.drop("window_date", "batch_id").exceptAll(metrics.repository_metrics(ev)).count() == 0
    assert metric_table(spark, scratch, "events").count() == ev.count()

    lake_top = reports.top_repositories(m, pipeline.AS_OF)
    direct = reports.top_repositories(metrics.repository_metrics(ev), pipeline.AS_OF)
    assert lake_top.collect() == direct.collect()
    plan = lake_top._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_date" in plan and "window_date#" in plan
    assert "PushedFilters: [IsNotNull(window_start), GreaterThanOrEqual(window_start" in plan


def test_panels_over_lake_prune_dates(spark, scratch):
    from eventide.plans import panels
    ev = pipeline.events(spark, SF_SMALL)
    tables.build_tables(spark, ev, scratch, ["repository_metrics"])
    m = metric_table(spark, scratch, "repository_metrics")
    direct = metrics.repository_metrics(ev)
    frm, to = pipeline.PANEL_FROM, pipeline.PANEL_TO
    for fn in (lambda t: panels.overall_trends(t, frm, to),
               lambda t: panels.repository_stars(t, frm, to),
               lambda t: panels.repository_activity(t, frm, to, pipeline.AS_OF)):
        lake = fn(m)
        assert sorted(lake.collect()) == sorted(fn(direct).collect())
        assert "PartitionFilters: [isnotnull(window_date" in \
            lake._jdf.queryExecution().executedPlan().toString()
    assert m.filter(F.col("window_date") < "2024-01-28").count() > 0


def _rows(spark, root, name):
    return metric_table(spark, root, name).drop("window_date", "batch_id")


def test_stream_and_build_share_a_lake(spark, scratch):
    from conftest import event, parsed
    from eventide import lake
    path = os.path.join(scratch, "events")
    days = [event(id=f"{d}{k}", created_at=f"2024-01-0{d}T23:50:00Z") for d in (2, 3, 4) for k in "ab"]
    ev = metrics.raw_events(parsed(spark, days[:4]))
    lake.append(ev, path, "events", "query-0")
    built = pipeline.clean(parsed(spark, [event(id="x", created_at="2024-01-03T10:00:00Z"), *days[4:]]))
    tables.build_tables(spark, built, scratch, ["events", "repository_metrics"])
    # rows that the build doesn't hold stay; dates mix writers
    every = ["2a", "2b", "3a", "3b", "4a", "4b", "x"]
    assert sorted(r.id for r in _rows(spark, scratch, "events").collect()) == every
    lake.append(metrics.raw_events(parsed(spark, days)), path, "events", "query-1")
    assert _rows(spark, scratch, "events").count() == 7
    # the windows touched are recomputed from all events, streamed ones too
    m = _rows(spark, scratch, "repository_metrics")
    got = m.select(F.date_format("window_start", "dd HH:mm").alias("at"), "event_count").collect()
    assert sorted(map(tuple, got)) == sorted(
        [(f"0{d} 23:{k:02}", 2) for d in (2, 3, 4) for k in (0, 15, 30, 45)]
        + [(f"03 {t}", 1) for t in ("09:15", "09:30", "09:45", "10:00")])
    # whole dates, only when asked to
    tables.build_tables(spark, built, scratch, ["repository_metrics"], replace=True)
    assert sorted(r.id for r in _rows(spark, scratch, "events").collect()) == ["2a", "2b", "4a", "4b", "x"]


def test_parts_of_a_day_lose_nothing(spark, scratch):
    import datetime as dt
    from eventide import lake
    from eventide.operators import quality
    day = pipeline.events(spark, SF_SMALL, since="2024-01-10 00:00:00", before="2024-01-11 00:00:00")
    bad = quality.rejected_records(pipeline.parsed(spark, SF_SMALL, defects=True))
    whole, parts = os.path.join(scratch, "whole"), os.path.join(scratch, "parts")
    tables.build_tables(spark, day, whole, rejected=bad)
    for part in (day.where("id % 3 = 0"), day.where("id % 3 <> 1"), day, day.where("id % 3 = 1")):
        tables.build_tables(spark, part, parts, rejected=bad)
    for name in ("events", "repository_metrics", "user_activity", "event_type_distribution",
                 "language_trends", "rejected_events"):
        a, b = (_rows(spark, root, name).drop("created_at") for root in (whole, parts))
        assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    assert _rows(spark, parts, "rejected_events").count() == bad.count()
    # where retention has taken raw events, windows are only added
    path = os.path.join(parts, "events")
    before = {name: _rows(spark, parts, name).count() for name in ("repository_metrics", "user_activity")}
    lake.expire(spark, path, "events", F.col("created_at") < F.lit("2024-01-11").cast("timestamp"),
                dt.date(2024, 1, 10))
    assert lake.horizon_of(spark, path) == dt.date(2024, 1, 10)
    tables.build_tables(spark, day.where("id % 3 = 0"), parts)
    assert {name: _rows(spark, parts, name).count() for name in before} == before
    w, p = (_rows(spark, root, "repository_metrics") for root in (whole, parts))
    assert w.exceptAll(p).count() == 0


def test_rebuild_keeps_windows_of_other_widths(spark, scratch):
    from eventide import lake
    ev = pipeline.events(spark, SF_SMALL, since="2024-01-10 00:00:00", before="2024-01-12 00:00:00")
    path = os.path.join(scratch, "repository_metrics")
    tables.build_tables(spark, ev, scratch, ["repository_metrics"])
    lake.append(metrics.repository_metrics(ev, "1 day", "1 day"), path, "repository_metrics", "daily")
    before = _rows(spark, scratch, "repository_metrics")
    want = sorted(map(tuple, before.collect()))
    for _ in range(2):
        tables.build_tables(spark, ev.where("id % 2 = 0"), scratch, ["repository_metrics"])
        assert sorted(map(tuple, _rows(spark, scratch, "repository_metrics").collect())) == want


def test_append_reads_only_the_dates_of_the_batch(spark, scratch, monkeypatch):
    from conftest import event, parsed
    from eventide import lake
    path = os.path.join(scratch, "events")
    far = [event(id="old", created_at="2014-01-01T10:00:00Z"), event(id="new")]
    mid = [event(id=f"m{k}", created_at=f"2020-05-0{k}T10:00:00Z") for k in range(1, 6)]
    lake.append(metrics.raw_events(parsed(spark, mid)), path, "events", "a")
    plans = []
    absent = lake.absent
    monkeypatch.setattr(lake, "absent", lambda b, t, *a, **k: plans.append(
        t._jdf.queryExecution().executedPlan().toString()) or absent(b, t, *a, **k))
    lake.append(metrics.raw_events(parsed(spark, far)), path, "events", "b")
    filters = plans[0].split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "window_date" in filters and " IN (" in filters.upper() and ">=" not in filters
    assert _rows(spark, scratch, "events").count() == 7


def test_empty_table_reads_as_no_rows(spark, scratch):
    from eventide.plans import views
    made = views.register(spark, scratch, pipeline.AS_OF, prefix="empty_")
    assert all(df.count() == 0 for df in made.values())
    assert spark.sql("SELECT * FROM empty_top_repositories").columns[0] == "repo_id"


def test_compact_keeps_rows_and_keys(spark, scratch):
    import datetime as dt
    from eventide import lake
    from eventide.schema import REPOSITORY_METRICS_TABLE
    path = os.path.join(scratch, "repository_metrics")
    at = dt.datetime(2024, 1, 30, 10, tzinfo=dt.timezone.utc)
    for k in range(3):
        rows = [(k, f"r{k}", at, at + dt.timedelta(hours=1), 1, 0, 0, 0, 0)]
        lake.append(spark.createDataFrame(rows, REPOSITORY_METRICS_TABLE), path,
                    "repository_metrics", f"q-{k}")
    day = at.date()
    assert len(lake.leaves(spark, path, [day])) == 3
    assert lake.compact(spark, path, "repository_metrics", dt.date(2024, 1, 31)) == 1
    assert len(lake.leaves(spark, path, [day])) == 1
    assert _rows(spark, scratch, "repository_metrics").count() == 3
    lake.append(spark.createDataFrame(rows, REPOSITORY_METRICS_TABLE), path,
                "repository_metrics", "q-2")            # a replay after the compaction
    assert _rows(spark, scratch, "repository_metrics").count() == 3


def test_expire_by_window_end_and_width(spark, scratch):
    import datetime as dt
    from eventide import lake
    from eventide.operators import maintenance
    from eventide.schema import REPOSITORY_METRICS_TABLE
    path = os.path.join(scratch, "repository_metrics")
    hour, day = dt.timedelta(hours=1), dt.timedelta(days=1)

    def rows(starts, width):
        return spark.createDataFrame(
            [(k, "r", s, s + width, 1, 0, 0, 0, 0) for k, s in enumerate(starts)],
            REPOSITORY_METRICS_TABLE)
    cut = dt.datetime(2024, 1, 16, tzinfo=dt.timezone.utc)
    # on either side of the cut, and begun before midnight but ended after it
    hourly = rows([cut - day, cut - dt.timedelta(minutes=15), cut - hour, cut + hour], hour)
    daily = rows([cut - 3 * day, cut - dt.timedelta(days=80), cut - dt.timedelta(days=61)], day)
    lake.append(hourly, path, "repository_metrics", "hourly")
    lake.append(daily, path, "repository_metrics", "daily")
    as_of = "2024-02-15 00:00:00"
    gone, part = lake.expire(spark, path, "repository_metrics",
                             maintenance.tier_expired(as_of=as_of), dt.date(2024, 1, 16))
    left = _rows(spark, scratch, "repository_metrics")
    want = maintenance.retain_tiered(hourly.unionByName(daily), as_of=as_of)
    assert left.exceptAll(want).count() == 0 and want.exceptAll(left).count() == 0
    # the expired hourly row shares its leaf with two that stay: rewritten, not deleted
    assert left.count() == 5 and (gone, part) == (1, 1)
    more = rows([cut - hour - dt.timedelta(minutes=1), cut - hour], hour)
    lake.append(more.filter("repo_id = 0").withColumn("repo_name", F.lit("s")).unionByName(
        more.filter("repo_id = 1").withColumn("repo_name", F.lit("s"))), path,
        "repository_metrics", "mixed")
    assert lake.expire(spark, path, "repository_metrics", maintenance.tier_expired(as_of=as_of),
                       dt.date(2024, 1, 16)) == (0, 1)      # one row of the leaf goes
    assert _rows(spark, scratch, "repository_metrics").filter("repo_name = 's'").count() == 1


def test_lake_queries_build_all_dates_and_tables(spark, scratch, monkeypatch):
    ev = pipeline.events(spark, SF_SMALL)
    days = {str(r[0]) for r in ev.select(F.to_date("created_at")).distinct().collect()}
    served = ["events", "repository_metrics", "event_type_distribution", "user_activity",
              "language_trends"]
    for query, want in ((catalog.q_lake_top_repositories, ["repository_metrics"]),
                        (catalog.q_view_event_type_summary, served)):
        root = os.path.join(scratch, query.__name__)
        monkeypatch.setattr(catalog, "scratch_dir", lambda spark, owner, root=root: root)
        query(spark, SF_SMALL)
        for name in want:
            built = {d.split("=")[1] for d in os.listdir(os.path.join(root, name)) if "=" in d}
            assert len(days) > 2 and days <= built, name
