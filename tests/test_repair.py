"""Late events: marks, repair, and streams of sessions and pairs."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from eventide import lake
from eventide.operators import metrics, sessions, temporal
from eventide.plans import repair
from eventide.sources.events import event_stream, metric_table
from eventide.streaming import runner
from test_streaming import _jsonl


def _drain(spark, land, root, tables, **kw):
    qs = runner.run_all(spark, event_stream(spark, "text", land, maxFilesPerTrigger=1),
                        os.path.join(root, "lake"), os.path.join(root, "ck"),
                        trigger={"availableNow": True}, tables=tables, with_rejected=False, **kw)
    runner.await_all(spark, qs, bounded=True)
    _drain.queries = {q.name: q for q in qs}
    return os.path.join(root, "lake")


def _files(land, batches):
    import time
    now = time.time() - 1000
    for i, evs in enumerate(batches):
        _jsonl(land, f"{i}.json", evs)
        os.utime(os.path.join(land, f"{i}.json"), (now + 10 * i, now + 10 * i))


def _rows(spark, root, name):
    return metric_table(spark, root, name).drop("window_date", "batch_id")


def test_repair_recomputes_marked_windows_only(spark, scratch, monkeypatch):
    from conftest import event, parsed
    batches = [[event(id="1", created_at="2024-01-02T10:00:00Z"),
                event(id="2", created_at="2024-01-03T12:00:00Z")],
               [event(id="3", created_at="2024-01-03T12:30:00Z")],
               [event(id="4", created_at="2024-01-02T10:05:00Z"),       # late
                event(id="5", created_at="2024-01-03T12:25:00Z"),       # out of order, not late
                event(id="2", created_at="2024-01-03T12:00:00Z")],      # late, a copy
               [event(id="6", created_at="2024-01-04T08:00:00Z")],
               [event(id="7", created_at="2024-01-04T07:40:00Z")]]      # late; its windows are open
    land = os.path.join(scratch, "land")
    _files(land, batches)
    names = ["events", "repository_metrics", "event_type_distribution"]
    root = _drain(spark, land, scratch, names, mode="update", staged=False, marks=True)
    marked = sorted(str(r[0]) for r in repair.dirty_windows(spark, root).select(
        F.date_format("window_start", "dd HH:mm")).collect())
    shut = ["02 09:15", "02 09:30", "02 09:45", "02 10:00", "03 11:15", "03 11:30", "03 11:45", "03 12:00"]
    assert marked == shut + ["04 06:45", "04 07:00", "04 07:15", "04 07:30"]
    from eventide.operators import enrich, quality
    ev = enrich.enrich(quality.dedup(quality.validate(parsed(
        spark, [e for b in batches for e in b]))[0]))
    want = {n: metrics.METRIC_TABLES[n](ev) for n in names[1:]}
    assert want[names[1]].exceptAll(_rows(spark, root, names[1])).count() > 0

    # a repair that fails leaves the marks; run again, it finishes
    upsert = lake.upsert

    def fail(df, path, table, batch_id):
        if table == "event_type_distribution":
            raise RuntimeError("lost")
        return upsert(df, path, table, batch_id)
    monkeypatch.setattr(lake, "upsert", fail)
    try:
        repair.repair(spark, root, names[1:])
        raise AssertionError("should fail")
    except RuntimeError:
        pass
    monkeypatch.setattr(lake, "upsert", upsert)
    assert repair.dirty_windows(spark, root).count() == 12
    # the watermark is at 07:50: of the last event's windows one is closed
    assert repair.repair(spark, root, names[1:]) == 9
    assert repair.repair(spark, root, names[1:]) == 0
    assert repair.dirty_windows(spark, root).count() == 3
    assert repair.repair(spark, root, names[1:], ended=True) == 3
    assert repair.dirty_windows(spark, root).count() == 0
    for name in names[1:]:
        got = _rows(spark, root, name)
        assert got.exceptAll(want[name]).count() == 0 and want[name].exceptAll(got).count() == 0, name
    # only the marked windows' dates have new leaves
    new = {str(d) for d, b in lake.leaves(
        spark, os.path.join(root, names[1]),
        sorted(r[0] for r in metric_table(spark, root, names[1]).select("window_date").distinct().collect()))
        if b.startswith("repair-")}
    assert new == {"2024-01-02", "2024-01-03", "2024-01-04"}


def test_streamed_sessions_and_pairs(spark, scratch):
    from conftest import PUSH_EVENT, STAR_EVENT, event, parsed
    def at(base, i, t, user=7001):
        return event(base, id=i, created_at=f"2024-01-02T{t}Z", actor__id=user)
    batches = [[at(PUSH_EVENT, "p1", "10:00:00"), at(STAR_EVENT, "s1", "10:20:00"),
                at(PUSH_EVENT, "p2", "10:45:00", 8)],
               [at(STAR_EVENT, "s2", "10:50:00"), at(PUSH_EVENT, "p3", "13:00:00"),
                at(STAR_EVENT, "s1", "10:20:00")],
               [at(STAR_EVENT, "s3", "18:00:00")], [at(STAR_EVENT, "s4", "20:00:00")]]
    land = os.path.join(scratch, "land")
    _files(land, batches)
    root = _drain(spark, land, scratch, ["session_activity", "push_then_star", "user_repositories"],
                  staged=False)
    # what is left in the join's state is younger than the interval and the delay
    held = [op["numRowsTotal"] for op in _drain.queries["push_then_star"].lastProgress["stateOperators"]
            if op["operatorName"] == "symmetricHashJoin"]
    assert held and held[0] <= 2           # the star at 20:00, in its two slots
    pairs = {(r.push_id, r.star_id) for r in _rows(spark, root, "push_then_star").collect()}
    assert pairs == {("p1", "s1"), ("p1", "s2"), ("p2", "s2"), ("p3", None)}
    assert _rows(spark, root, "push_then_star").count() == 4          # the late side once
    from eventide.operators import quality
    ev = quality.dedup(quality.validate(parsed(spark, [e for b in batches for e in b]))[0])
    closed = sessions.session_activity(ev).where("window_end <= '2024-01-02 19:50:00'")
    got = _rows(spark, root, "session_activity")
    assert closed.count() == 4
    assert got.exceptAll(closed).count() == 0 and closed.exceptAll(got).count() == 0
    assert temporal.push_then_star(ev).count() == 3
    from eventide.operators import distinct
    hours = metric_table(spark, root, "user_repositories")
    assert hours.count() == 4 and {(r.user_id, r.distinct_repos) for r in distinct.sketched_repositories(
        hours).collect()} == {(7001, 1), (8, 1)}
    # nothing new: a restart writes nothing twice
    _drain(spark, land, scratch, ["session_activity", "push_then_star"], staged=False)
    assert _rows(spark, root, "push_then_star").count() == 4
