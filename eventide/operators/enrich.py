"""Derived event fields (E3-E5), as column expressions over the payload.

``payload`` is either the full ``map<string,string>`` or the narrow struct of
the keys read here (``schema.PAYLOAD_SLIM``); ``payload[key]`` works on both.
Nested JSON values arrive as text and are decoded with a second, narrow
``from_json`` / ``get_json_object``. Bad nested JSON decodes to null and
contributes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import REPOSITORY_METRICS

_COMMITS = "array<struct<languages:array<string>>>"


def languages() -> Column:
    """Distinct languages of an event, sorted.

    Push events: the union of ``payload.commits[*].languages`` (commits
    without the field add nothing). Create events: ``payload.language`` when
    ``payload.ref_type = 'repository'``. Any other event: empty.
    """
    p = F.col("payload")
    commits = F.from_json(p.getItem("commits"), _COMMITS)
    push = F.flatten(F.transform(
        F.coalesce(commits, F.array().cast(_COMMITS)),
        lambda c: F.coalesce(c.getField("languages"), F.array().cast("array<string>"))))
    create = F.when(p.getItem("ref_type") == "repository",
                    F.array(p.getItem("language")))
    derived = (F.when(F.col("type") == "PushEvent", push)
                .when(F.col("type") == "CreateEvent", create))
    derived = F.coalesce(derived, F.array().cast("array<string>"))
    return F.array_sort(F.array_distinct(F.array_compact(derived)))


def repository_metrics() -> Column:
    """Per-event repository counters.

    Watch events with action ``started`` -> stars=1; fork events -> forks=1;
    issue and pull-request events with ``payload.repository`` -> the absolute
    stargazer / fork / watcher / open-issue counts it carries. Increments and
    absolute counts share columns: never sum them across event types.
    """
    p = F.col("payload")
    t = F.col("type")
    repo_json = p.getItem("repository")
    has_repo = t.isin("PullRequestEvent", "IssuesEvent") & repo_json.isNotNull()

    def counter(field: str) -> Column:
        return F.get_json_object(repo_json, f"$.{field}").try_cast("bigint")

    stars = (F.when((t == "WatchEvent") & (p.getItem("action") == "started"), F.lit(1))
              .when(has_repo, counter("stargazers_count")))
    forks = (F.when(t == "ForkEvent", F.lit(1))
              .when(has_repo, counter("forks_count")))
    watchers = F.when(has_repo, counter("watchers_count"))
    open_issues = F.when(has_repo, counter("open_issues_count"))
    return F.struct(
        F.col("repo.id").alias("repo_id"),
        F.col("repo.name").alias("repo_name"),
        stars.cast("bigint").alias("stars"),
        forks.cast("bigint").alias("forks"),
        watchers.cast("bigint").alias("watchers"),
        open_issues.cast("bigint").alias("open_issues"),
    ).cast(REPOSITORY_METRICS)


def enrich(df: DataFrame) -> DataFrame:
    """Attach ``languages`` and ``repository_metrics``.

    Values already present on the event (an upstream that enriched it) win;
    otherwise they are derived from the payload.
    """
    return df.withColumns({
        "languages": F.coalesce(F.col("languages"), languages()),
        "repository_metrics": F.coalesce(F.col("repository_metrics"), repository_metrics()),
    })
