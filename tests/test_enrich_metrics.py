from __future__ import annotations

from conftest import PUSH_EVENT, STAR_EVENT, event, parsed
from eventide.operators import enrich, metrics


def _langs(spark, evs):
    return [r.languages for r in enrich.enrich(parsed(spark, evs)).collect()]


def test_push_languages(spark):
    assert _langs(spark, [PUSH_EVENT]) == [["Elixir", "Kotlin"]]


def test_push_language_edge_cases(spark):
    evs = [
        event(PUSH_EVENT, payload={}),                                   # no commits
        event(PUSH_EVENT, payload={"commits": []}),                      # empty
        event(PUSH_EVENT, payload={"commits": None}),                    # null
        event(PUSH_EVENT, payload={"commits": [{"sha": "a"},             # some without
                                               {"languages": ["Go", "Go", "Rust"]}]}),
    ]
    assert _langs(spark, evs) == [[], [], [], ["Go", "Rust"]]


def test_create_event_languages(spark):
    repo = event(type="CreateEvent", payload={"ref_type": "repository", "language": "Java"})
    branch = event(type="CreateEvent", payload={"ref_type": "branch", "language": "Java"})
    none = event(type="CreateEvent", payload={"ref_type": "repository"})
    assert _langs(spark, [repo, branch, none]) == [["Java"], [], []]


def test_existing_languages_win(spark):
    assert _langs(spark, [event(languages=["Haskell"])]) == [["Haskell"]]


def _rm(spark, evs):
    return [r.repository_metrics for r in enrich.enrich(parsed(spark, evs)).collect()]


def test_repository_metrics_fixture(spark):
    m = _rm(spark, [STAR_EVENT])[0]
    assert (m.repo_id, m.repo_name, m.stars, m.forks) == (8802, "fjord/lantern", 1, None)


def test_repository_metrics_cases(spark):
    unstar = event(payload={"action": "stopped"})
    fork = event(type="ForkEvent", payload={"forkee": {"id": 1}})
    issue = event(type="IssuesEvent", payload={"action": "opened", "repository": {
        "stargazers_count": 10, "forks_count": 2, "watchers_count": 11, "open_issues_count": 3}})
    bare_issue = event(type="IssuesEvent", payload={"action": "opened"})
    got = [(m.stars, m.forks, m.watchers, m.open_issues)
           for m in _rm(spark, [unstar, fork, issue, bare_issue])]
    assert got == [(None, None, None, None), (None, 1, None, None), (10, 2, 11, 3),
                   (None, None, None, None)]


def _at(ts):
    return f"2024-01-02T{ts}Z"


def test_boundary_event_in_four_windows(spark):
    df = metrics.event_type_distribution(parsed(spark, [event(created_at=_at("00:15:00"))]))
    starts = sorted(str(r.window_start) for r in df.collect())
    assert starts == ["2024-01-01 23:30:00", "2024-01-01 23:45:00",
                      "2024-01-02 00:00:00", "2024-01-02 00:15:00"]
    assert all(str(r.window_end) > "2024-01-02 00:15:00" for r in df.collect())


def test_repository_metrics_counts_and_rename(spark):
    evs = [event(id="1", created_at=_at("10:01:00")),
           event(id="2", type="ForkEvent", created_at=_at("10:02:00")),
           event(id="3", type="IssuesEvent", created_at=_at("10:03:00")),
           event(id="4", repo__name="fjord/beacon", created_at=_at("10:04:00"))]
    df = metrics.repository_metrics(parsed(spark, evs)).filter("window_start = '2024-01-02 10:00:00'")
    rows = {r.repo_name: r for r in df.collect()}
    assert set(rows) == {"fjord/lantern", "fjord/beacon"}
    r = rows["fjord/lantern"]
    assert (r.event_count, r.stars, r.forks, r.pull_requests, r.issues) == (3, 1, 1, 0, 1)


def test_user_activity_distinct_repos_and_types(spark):
    evs = [event(id="1", created_at=_at("10:01:00")),
           event(id="2", created_at=_at("10:02:00"), type="PushEvent"),
           event(id="3", created_at=_at("10:03:00"), repo__id=999, type="PushEvent"),
           event(id="4", created_at=_at("10:04:00"), repo__id=None)]
    df = metrics.user_activity(parsed(spark, evs), event_types_form="list").filter("window_start = '2024-01-02 10:00:00'")
    r = df.collect()[0]
    assert r.event_count == 4
    assert r.repos_contributed == 2          # null repo id is not counted
    assert r.event_types == "PushEvent,PushEvent,WatchEvent,WatchEvent"
    counts = metrics.user_activity(parsed(spark, evs))
    assert counts.filter("window_start = '2024-01-02 10:00:00'").collect()[0].event_types == \
        "PushEvent:2,WatchEvent:2"


def test_language_trends_skip_empty(spark):
    evs = [enrich.enrich(parsed(spark, [PUSH_EVENT, STAR_EVENT]))]
    df = metrics.language_trends(evs[0])
    langs = {r.language for r in df.collect()}
    assert langs == {"Elixir", "Kotlin"}
    assert df.count() == 8


def test_raw_events_projection(spark):
    cols = metrics.raw_events(parsed(spark, [STAR_EVENT])).columns
    assert cols == ["id", "type", "actor_id", "actor_login", "repo_id", "repo_name",
                    "created_at", "collected_at", "processed_at", "public"]
