"""Property and skew checks."""

from __future__ import annotations

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import event, parsed
from eventide.operators import metrics, quality

BASE = dt.datetime(2024, 1, 2, 0, 0, 0)


def _iso(t: dt.datetime) -> str:
    return t.strftime("%Y-%m-%dT%H:%M:%S.%f") + "Z"


events_strategy = st.lists(
    st.tuples(st.integers(0, 5),                # repo
              st.integers(0, 3),                # user
              st.integers(0, 6 * 3600 - 1),     # seconds after BASE
              st.integers(0, 2)),               # extra copies sent later
    min_size=1, max_size=25)


@settings(max_examples=6, deadline=None)
@given(events_strategy)
def test_dedup_then_metrics_equals_unique_events(spark, evs):
    unique, sent = [], []
    for i, (repo, user, sec, copies) in enumerate(evs):
        created = BASE + dt.timedelta(seconds=sec)
        e = event(id=str(i), repo__id=repo, repo__name=f"o/r{repo}", actor__id=user,
                  actor__login=f"u{user}", created_at=_iso(created),
                  collected_at=_iso(created + dt.timedelta(seconds=60)))
        unique.append(e)
        sent.append(e)
        for c in range(copies):
            sent.append({**e, "collected_at": _iso(created + dt.timedelta(seconds=120 + c)),
                         "public": False})
    d = quality.dedup(parsed(spark, sent))
    rows = d.collect()
    assert sorted(r.id for r in rows) == sorted(str(i) for i in range(len(evs)))
    assert all(r.public for r in rows)              # the first-collected copy wins
    u = parsed(spark, unique)
    for build in (metrics.repository_metrics, metrics.user_activity):
        assert build(d).exceptAll(build(u)).count() == 0
        assert build(u).exceptAll(build(d)).count() == 0
    # every event lies in exactly four sliding windows
    total = metrics.event_type_distribution(d).groupBy().sum("event_count").collect()[0][0]
    assert total == 4 * len(evs)


def test_hot_user_and_repo_hold_a_third(spark):
    evs = []
    for i in range(300):
        hot = i % 3 == 0
        evs.append(event(id=str(i), actor__id=1 if hot else 100 + i, actor__login="bot" if hot else f"u{i}",
                         repo__id=7 if hot else 1000 + i, repo__name="o/hot" if hot else f"o/r{i}",
                         type="PushEvent" if i % 2 else "WatchEvent",
                         created_at=_iso(BASE + dt.timedelta(seconds=i))))
    ev = parsed(spark, evs)
    ua = metrics.user_activity(ev, event_types_form="counts").filter(
        "user_id = 1 AND window_start = '2024-01-02 00:00:00'").collect()[0]
    assert (ua.event_count, ua.repos_contributed) == (100, 1)
    assert ua.event_types == "PushEvent:50,WatchEvent:50"
    rm = metrics.repository_metrics(ev).filter(
        "repo_id = 7 AND window_start = '2024-01-02 00:00:00'").collect()[0]
    assert (rm.event_count, rm.stars) == (100, 50)
