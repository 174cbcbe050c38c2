"""Ranks, moving frames, rollups, distinct counts and table comparison."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from test_time_joins import START, events, random_events
from eventide.operators import compare, distinct, trends


def test_trend_matches_brute_force(spark):
    rows = random_events(11, 2500, span=86_400 * 20)
    n = {}
    for _, _, _, repo, s in rows:
        n[repo, s // 3600] = n.get((repo, s // 3600), 0) + 1
    want = []
    for (repo, hour), k in n.items():
        rank = 1 + sum(v > k for (_, h), v in n.items() if h == hour)
        day = sum(n.get((repo, hour - back), 0) for back in range(24))
        want.append((repo, hour, k, rank, k - n.get((repo, hour - 1), 0), day))
    for span in ("7 days", "24 hours"):
        out = trends.repository_trend(events(spark, rows), span).select(
            "repo_id", ((F.unix_timestamp("hour") - int(START.timestamp())) / 3600).cast("long"),
            "event_count", "rank", "change", "moving_24h")
        assert sorted(map(tuple, out.collect())) == sorted(want)


def test_frames_and_ranks_never_hold_a_whole_key(spark):
    counts = trends.hourly_counts(events(spark, random_events(12, 200, span=86_400 * 60)))
    plan = trends.framed(trends.ranked(counts, "hour", "event_count"), ["repo_id"], "hour", "24 hours",
                         {"s": F.sum("event_count")})._jdf.queryExecution().executedPlan().toString()
    keys = [x.split("hashpartitioning(")[1].split("),")[0] for x in plan.split("\n")
            if "hashpartitioning(" in x]
    assert any("repo_id" in k and "_span" in k for k in keys)
    assert "SinglePartition" not in plan


def test_ranks_with_ties(spark):
    df = spark.createDataFrame([("a", 3), ("a", 3), ("a", 1), ("b", 1), ("b", None)], "g string, v int")
    assert sorted((r.g, r.v, r["rank"]) for r in trends.ranked(df.dropna(), "g", "v").collect()) == [
        ("a", 1, 3), ("a", 3, 1), ("a", 3, 1), ("b", 1, 1)]


def test_rollup_is_the_union_of_single_reports(spark):
    ev = events(spark, random_events(13, 600, span=86_400 * 50))
    path = ev.withColumn("languages", F.when(F.col("id") % 4 == 0, None).otherwise(F.expr(
        "transform(sequence(0, cast(id % 3 as int)), x -> element_at(array('Go', 'C', 'R'), "
        "cast((id + x) % 3 + 1 as int)))")))
    out = {tuple(x) for x in trends.type_language_rollup(path).collect()}
    said = path.select("type", "created_at", F.explode(F.concat(F.array(F.lit("(all)")), F.coalesce(
        F.array_distinct("languages"), F.array().cast("array<string>")))).alias("language"))
    want = set()
    for grain in ("hour", "day", "month"):
        for kind in (F.col("type"), F.lit("(all)")):
            want |= {tuple(x) for x in said.groupBy(
                F.lit(grain), F.date_trunc(grain, "created_at"), kind, "language").count().collect()}
    assert out == want and len(out) > 500
    plan = trends.type_language_rollup(path)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1


def test_distinct_repositories_and_sketch_error(spark):
    rows = random_events(14, 4000) + [(f"z{k}", "PushEvent", 500, 10 ** 6 + k, k * 10) for k in range(9000)]
    ev = events(spark, rows)
    want = {u: len({r[3] for r in rows if r[2] == u}) for u in {r[2] for r in rows}}
    exact = {r.user_id: r.distinct_repos for r in distinct.exact_repositories(ev).collect()}
    assert exact == want
    stored = distinct.user_repository_sketches(ev)
    about = {r.user_id: r.distinct_repos for r in distinct.sketched_repositories(stored).collect()}
    assert all(abs(about[u] - n) <= 0.5 + distinct.SKETCH_ERROR * n for u, n in want.items())
    assert all(about[u] == n for u, n in want.items() if n < 200)


def test_comparison_finds_planted_differences_only(spark):
    rows = [(k, f"v{k % 7}", dt.date(2024, 1, 1 + k % 5) if k % 11 else None) for k in range(300)]
    schema = "k long, v string, d date"
    left = spark.createDataFrame(rows + rows[:4] + [rows[3]], schema)
    right = spark.createDataFrame([r for r in rows if r[0] != 20] + rows[:4]
                                  + [(999, None, dt.date(2024, 2, 1))] * 2, schema)
    got = sorted(map(tuple, compare.differences(left, right, F.col("d")).collect()), key=str)
    assert got == sorted([(*rows[20], "left", 1), (*rows[3], "left", 1),
                          (999, None, dt.date(2024, 2, 1), "right", 2)], key=str)
    days = compare.differing_dates(left, right, ["k", "v", "d"], F.col("d"))
    assert set(days) == {rows[20][2], rows[3][2], dt.date(2024, 2, 1)}
    assert compare.differences(left, left, F.col("d")).count() == 0
    null = compare.differences(left, left.where("d IS NOT NULL"), F.col("d"))
    assert {r.d for r in null.collect()} == {None} and null.agg(F.sum("copies")).first()[0] == left.where("d IS NULL").count()
