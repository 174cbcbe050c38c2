"""Sessions and joins by time against brute force, and the shape of their plans."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import SF_SMALL
from eventide.operators import sessions, temporal
from eventide.plans import pipeline

UTC = dt.timezone.utc
START = dt.datetime(2024, 1, 2, tzinfo=UTC)
EVENT = ("id string, type string, actor struct<id:long,login:string>, "
         "repo struct<id:long,name:string>, created_at timestamp")


def events(spark, rows):
    """(id, type, user, repo, seconds after START or None)."""
    return spark.createDataFrame(
        [(i, t, (u, f"u{u}"), (r, f"r{r}"), None if s is None else START + dt.timedelta(seconds=s))
         for i, t, u, r, s in rows], EVENT)


def random_events(seed, n, hot=0.34, span=200_000):
    r = random.Random(seed)
    return [(str(k), r.choice(["PushEvent", "WatchEvent", "IssuesEvent"]),
             0 if r.random() < hot else r.randrange(1, 30), 0 if r.random() < hot else r.randrange(1, 20),
             r.choice([r.randrange(span), r.randrange(0, span, 900)])) for k in range(n)]


def micros(c):
    return F.unix_micros(c) - int(START.timestamp()) * 1_000_000


def test_sessions_match_brute_force(spark):
    rows = random_events(1, 1500) + [("x", "PushEvent", 99, 1, 0), ("y", "ForkEvent", 99, 1, 1800),
                                     ("z", "PushEvent", 99, 1, 3601), ("w", "Odd", 99, 1, 3601)]
    want = []
    for user in {r[2] for r in rows}:
        mine = sorted((r[4], r[1]) for r in rows if r[2] == user)
        runs = [[mine[0]]]
        for a, b in zip(mine, mine[1:]):
            runs[-1].append(b) if b[0] - a[0] <= 1800 else runs.append([b])
        want += [(user, run[0][0], run[-1][0] + 1800, len(run), sum(t == "PushEvent" for _, t in run))
                 for run in runs]
    out = sessions.session_activity(events(spark, rows)).select(
        "user_id", (micros("window_start") / 1e6).cast("long"),
        (micros("window_end") / 1e6).cast("long"), "event_count", "pushes")
    assert sorted(map(tuple, out.collect())) == sorted(want)


def test_hot_user_is_one_row_per_slot_before_sessions_merge(spark):
    spans = sessions.slot_spans(events(spark, random_events(2, 3000, hot=0.9)), "30 minutes")
    assert spans.where("user_id = 0").count() <= 200_000 // 1800 + 1
    plan = sessions.session_activity(events(spark, random_events(2, 10)))._jdf.queryExecution(
        ).executedPlan().toString()
    assert plan.count("partial_sum") >= 6 and "Window" not in plan.split("Exchange")[-1]


def test_followed_by_matches_brute_force(spark):
    rows = random_events(3, 700) + [("n", "PushEvent", 1, 0, None), ("m", "WatchEvent", 1, 0, None)]
    want = sorted((a[0], b[0]) for a in rows for b in rows
                  if a[1] == "PushEvent" and b[1] == "WatchEvent" and a[3] == b[3]
                  and None not in (a[4], b[4]) and 0 <= b[4] - a[4] <= 3600)
    ev = events(spark, rows)
    inner = temporal.push_then_star(ev).select("push_id", "star_id")
    assert sorted(map(tuple, inner.collect())) == want
    outer = temporal.push_then_star(ev, how="left_outer").select("push_id", "star_id").collect()
    alone = {r[0] for r in rows if r[1] == "PushEvent"} - {a for a, _ in want}
    assert sorted(map(tuple, outer), key=str) == sorted(want + [(a, None) for a in alone], key=str)
    plan = temporal.push_then_star(ev)._jdf.queryExecution().executedPlan().toString()
    assert "_slot" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_as_of_matches_brute_force(spark):
    rows = random_events(4, 900)
    left = [r for r in rows if r[1] != "IssuesEvent"] + [("n", "WatchEvent", 1, 0, None)]
    right = [r for r in rows if r[1] == "IssuesEvent"] + [("q", "IssuesEvent", 1, 0, None)]

    def frames():
        a = events(spark, left).select("id", F.col("repo.id").alias("repo_id"), "created_at",
                                       F.lit(7).alias("who"))
        b = events(spark, right).select(F.col("repo.id").alias("repo_id"), F.col("actor.id").alias("who_last"),
                                        F.col("created_at").alias("seen_at"), F.col("id").alias("rid"))
        return a, b
    for inclusive in (False, True):
        want = []
        for i, _, _, repo, at in left:
            known = [(r[4], r[0], r[2]) for r in right if r[3] == repo and None not in (at, r[4])
                     and (r[4] < at or inclusive and r[4] == at)]
            want.append((i, max(known)[2] if known else None))
        for span in ("1 day", "1 hour", "20 minutes"):
            out = temporal.as_of_join(*frames(), ["repo_id"], "created_at", "seen_at", ["who_last"],
                                      "rid", span, inclusive)
            assert sorted(map(tuple, out.select("id", "who_last").collect())) == sorted(want)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "hashpartitioning(repo_id" in plan and "_span" in plan


def test_intervals_match_brute_force(spark):
    r = random.Random(5)
    rows = random_events(6, 400)
    holes = [(k, r.randrange(20), a, a + r.choice([0, 1, 60, 900, 901, 5000, 40_000, 150_000]))
             for k, a in enumerate(r.choices(range(0, 200_000, 300), k=120))] + [(998, 0, 500, 400)]

    def shifted(s):
        return START + dt.timedelta(seconds=s)
    intervals = spark.createDataFrame([(k, repo, shifted(a), shifted(b)) for k, repo, a, b in holes],
                                      "hole long, repo_id long, began timestamp, ended timestamp")
    points = events(spark, rows).select("id", F.col("repo.id").alias("repo_id"), "created_at")
    free = temporal.interval_join(points.drop("repo_id"), intervals, "created_at", "began", "ended")
    want = sorted((p[0], k) for p in rows for k, _, a, b in holes if a <= p[4] < b)
    assert sorted(map(tuple, free.select("id", "hole").collect())) == want
    keyed = temporal.interval_join(points, intervals, "created_at", "began", "ended", ["repo_id"])
    want = sorted((p[0], k) for p in rows for k, repo, a, b in holes if a <= p[4] < b and p[3] == repo)
    assert sorted(map(tuple, keyed.select("id", "hole").collect())) == want
    none = temporal.interval_join(points.drop("repo_id"), intervals.limit(0), "created_at", "began", "ended")
    assert none.count() == 0
    plan = free._jdf.queryExecution().executedPlan().toString()
    assert "_at_slot" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_interval_lies_in_two_slots_at_most(spark):
    lengths = [1, 10 ** 6, 10 ** 9, 10 ** 12, 10 ** 15, 2 * 10 ** 15]
    rows = [(k, n) for k, n in enumerate(lengths)]
    df = spark.createDataFrame(rows, "k long, n long").select(
        "k", F.timestamp_micros(F.lit(1_700_000_000_123_457)).alias("a"),
        F.timestamp_micros(F.lit(1_700_000_000_123_457) + F.col("n")).alias("b"))
    points = df.select(F.col("k").alias("p"), F.col("a").alias("t")).limit(1)
    assert temporal.interval_join(points, df, "t", "a", "b").count() == len(lengths)
    assert temporal.interval_join(points.withColumn("t", F.col("t") - F.expr("INTERVAL 1 MICROSECOND")),
                                  df, "t", "a", "b").count() == 0


def test_sessions_of_the_given_table(spark):
    ev = pipeline.events(spark, SF_SMALL)
    out = sessions.session_activity(ev)
    assert out.agg(F.sum("event_count")).first()[0] == ev.count()
