"""Turn the driver's ``events`` table into landed JSON event records.

Every query goes through the real ingest path: the flat test table is
re-shaped into nested activity events, serialised with ``to_json`` into the
``(key, value)`` transport record, and parsed back by ``functions.parse``.
All of it is column expressions, so it partitions with the input table.

Mapping of a row ``(event_id, ts, user_id, event_type, value, props)`` with
``k = props.k``:

* ``id`` = event_id as text; ``type`` by ``event_type`` (see EVENT_TYPE_MAP,
  ``signup`` becomes a fork for even ``k`` and a create event otherwise);
* ``actor`` = the user, ``repo`` = repository ``k`` named ``org/repo_<k>``;
* ``created_at`` = ts (ISO-8601, UTC, microseconds), ``collected_at`` = ts+60s;
* ``payload`` by type: push events carry commits with languages chosen by
  ``k % 5``, watch events an action, issue / pull-request events repository
  counters (absent when ``k % 3 = 0``), create events a ref type and language.

Two opt-in variants exercise the quality stages (they keep every input row):
``defects=True`` damages some records in a fixed, id-derived way and
``replays=True`` sends some records a second time, later and altered, the way
a collector that re-polls a page does; some copies share their collection time
or carry none, and differ in several fields.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values of the adapter --------------------------------------------
EVENT_TYPE_MAP = {
    "click": "PushEvent",
    "view": "WatchEvent",
    "error": "IssuesEvent",
    "purchase": "PullRequestEvent",
}
SIGNUP_EVEN_K = "ForkEvent"
SIGNUP_ODD_K = "CreateEvent"

# languages carried by the commits of a push event, by k % 5; None = the
# commit has no ``languages`` field; a missing list = no commits at all
PUSH_COMMIT_LANGUAGES = {
    0: [["Python", "JavaScript"], ["Python"]],
    1: [["Go"]],
    2: [["Rust", "TypeScript"], None],
    3: [],
}
# language of a create event, by (k div 4) % 5; index 4 = no language
CREATE_LANGUAGES = ["Python", "Java", "Go", "Ruby"]

ISO_MICROS_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

# defect kinds by event_id % 50 (only with defects=True)
DEFECT_MOD = 50
DEFECT_NO_REPO_NAME = 7
DEFECT_BAD_CREATED_AT = 13
DEFECT_MALFORMED_JSON = 21
DEFECT_UNKNOWN_TYPE = 29
DEFECT_NO_ACTOR_ID = 33
DEFECT_BAD_COLLECTED_AT = 41
UNKNOWN_TYPE_NAME = "SponsorshipTierEvent"

# replayed records: event_id % 10 = 3, sent again 5 minutes later, not public
REPLAY_MOD = 10
REPLAY_REM = 3
REPLAY_DELAY_SECONDS = 300
# event_id % 10 = 4: a copy collected at the same instant, of another type, by
# another actor and not public; its type sorts first
TIE_REM = 4
TIE_TYPE = "CommitCommentEvent"
# event_id % 10 = 5: neither the record nor its copy says when it was
# collected; the copy's type sorts last
UNDATED_REM = 5
UNDATED_TYPE = "ZoneEvent"
OTHER_ACTOR = 1_000_000


# The event is written as one Spark SQL expression (parsed on the JVM in a
# single call) over the helper columns ``_k`` (props.k) and ``_t`` (type).

def _lit(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


_COMMIT_TYPE = "array<struct<sha:string,message:string,languages:array<string>>>"


def _commit_sql(seq: int, langs) -> str:
    languages = ("CAST(NULL AS array<string>)" if langs is None
                 else "CAST(array(" + ", ".join(_lit(x) for x in langs) + ") AS array<string>)")
    return (f"named_struct('sha', concat('c', CAST(event_id AS STRING), '_{seq}'), "
            f"'message', 'commit {seq}', 'languages', {languages})")


def _commits_sql() -> str:
    branches = " ".join(
        f"WHEN {rem} THEN CAST(array({', '.join(_commit_sql(i + 1, l) for i, l in enumerate(cs))})"
        f" AS {_COMMIT_TYPE})"
        for rem, cs in PUSH_COMMIT_LANGUAGES.items())
    return f"CASE _k % 5 {branches} END"


def _type_sql() -> str:
    branches = " ".join(f"WHEN event_type = {_lit(a)} THEN {_lit(b)}"
                        for a, b in EVENT_TYPE_MAP.items())
    return (f"CASE {branches} "
            f"WHEN event_type = 'signup' AND _k % 2 = 0 THEN {_lit(SIGNUP_EVEN_K)} "
            f"WHEN event_type = 'signup' THEN {_lit(SIGNUP_ODD_K)} "
            f"ELSE event_type END")


def _payload_sql() -> str:
    issue_or_pr = "_t IN ('IssuesEvent', 'PullRequestEvent')"
    create_langs = ", ".join(_lit(x) for x in CREATE_LANGUAGES + [None])
    return f"""named_struct(
      'action', CASE WHEN _t = 'WatchEvent'
                     THEN CASE WHEN _k % 10 = 9 THEN 'stopped' ELSE 'started' END
                     WHEN {issue_or_pr} THEN 'opened' END,
      'commits', CASE WHEN _t = 'PushEvent' THEN {_commits_sql()} END,
      'repository', CASE WHEN {issue_or_pr} AND _k % 3 != 0 THEN named_struct(
          'stargazers_count', _k * 10, 'forks_count', _k,
          'watchers_count', _k * 10 + 1, 'open_issues_count', _k % 7) END,
      'forkee', CASE WHEN _t = 'ForkEvent' THEN named_struct(
          'id', event_id,
          'full_name', concat('user_', CAST(user_id AS STRING), '/repo_', CAST(_k AS STRING))) END,
      'ref_type', CASE WHEN _t = 'CreateEvent'
                       THEN CASE WHEN _k % 4 = 1 THEN 'repository' ELSE 'branch' END END,
      'language', CASE WHEN _t = 'CreateEvent'
                       THEN element_at(array({create_langs}), CAST(floor(_k / 4) % 5 + 1 AS INT)) END)"""


def _event_sql(defects: bool, collected_delay: int, public: str, undated: bool) -> str:
    login = "concat('user_', CAST(user_id AS STRING))"
    collected = (f"date_format(ts + make_interval(0, 0, 0, 0, 0, 0, {collected_delay}), "
                 f"\"{ISO_MICROS_UTC}\")")
    if undated:
        collected = f"CASE WHEN event_id % {REPLAY_MOD} != {UNDATED_REM} THEN {collected} END"
    repo_name = "concat('org/repo_', CAST(_k AS STRING))"
    created = f"date_format(ts, \"{ISO_MICROS_UTC}\")"
    actor_id = "user_id"
    if defects:
        d = f"event_id % {DEFECT_MOD}"
        repo_name = f"CASE WHEN {d} = {DEFECT_NO_REPO_NAME} THEN NULL ELSE {repo_name} END"
        created = f"CASE WHEN {d} = {DEFECT_BAD_CREATED_AT} THEN 'garbage' ELSE {created} END"
        actor_id = f"CASE WHEN {d} = {DEFECT_NO_ACTOR_ID} THEN NULL ELSE user_id END"
        collected = f"CASE WHEN {d} = {DEFECT_BAD_COLLECTED_AT} THEN 'garbage' ELSE {collected} END"
    return f"""named_struct(
      'id', CAST(event_id AS STRING),
      'type', _t,
      'actor', named_struct(
          'id', {actor_id}, 'login', {login}, 'display_login', {login},
          'url', concat('https://api.example.invalid/users/', {login}),
          'avatar_url', concat('https://avatars.example.invalid/u/', CAST(user_id AS STRING))),
      'repo', named_struct(
          'id', _k, 'name', {repo_name},
          'url', concat('https://api.example.invalid/repos/org/repo_', CAST(_k AS STRING))),
      'payload', {_payload_sql()},
      'public', {public},
      'created_at', {created},
      'collected_at', {collected})"""


def _records(events: DataFrame, defects: bool, delay: int, public: str,
             keep: tuple[str, ...] = (), undated: bool = False,
             as_type: str | None = None) -> DataFrame:
    # k and the event type are computed once per row and referenced by name
    t = _lit(as_type) if as_type else _type_sql()
    if defects:
        t = (f"CASE WHEN event_id % {DEFECT_MOD} = {DEFECT_UNKNOWN_TYPE} "
             f"THEN {_lit(UNKNOWN_TYPE_NAME)} ELSE {t} END")
    base = (events.select("event_id", "ts", "user_id", "event_type", *keep,
                          F.get_json_object("props", "$.k").cast("bigint").alias("_k"))
                  .withColumn("_t", F.expr(t)))
    ev = F.expr(_event_sql(defects, delay, public, undated))
    value = F.to_json(ev)
    if defects:
        # a truncated message: the JSON text stops in the middle of the object
        value = F.when(F.col("event_id") % DEFECT_MOD == DEFECT_MALFORMED_JSON,
                       F.substring(value, 1, 40)).otherwise(value)
    repo_name = ev.getField("repo").getField("name")
    return base.select(repo_name.alias("key"), value.alias("value"), *keep)


def landed_records(events: DataFrame, defects: bool = False, replays: bool = False,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """``(key, value)`` JSON records for every row of ``events`` (plus the
    ``keep`` columns of the input, e.g. ``ts`` to land them in time order)."""
    out = _records(events, defects, 60, "true", keep, undated=replays)
    if replays:
        rem = F.col("event_id") % REPLAY_MOD
        again = events.filter(rem == REPLAY_REM)
        other = events.withColumn("user_id", F.col("user_id") + OTHER_ACTOR)
        out = (out.unionByName(_records(again, defects, 60 + REPLAY_DELAY_SECONDS, "false", keep))
               .unionByName(_records(other.filter(rem == TIE_REM), defects, 60, "false", keep,
                                     as_type=TIE_TYPE))
               .unionByName(_records(other.filter(rem == UNDATED_REM), defects, 60, "false", keep,
                                     undated=True, as_type=UNDATED_TYPE)))
    return out
