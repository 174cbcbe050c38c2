"""Declared schemas (never inferred) for events and the served tables.

Ids are ``LongType`` throughout: an id above 2**31-1 must not silently turn
into null. Counts are ``LongType`` as well.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: the event type names treated as known --------------------
KNOWN_EVENT_TYPES = (
    "CommitCommentEvent", "CreateEvent", "DeleteEvent", "ForkEvent",
    "GollumEvent", "IssueCommentEvent", "IssuesEvent", "MemberEvent",
    "PublicEvent", "PullRequestEvent", "PullRequestReviewEvent",
    "PullRequestReviewCommentEvent", "PushEvent", "ReleaseEvent",
    "SponsorshipEvent", "WatchEvent",
)

# Default sliding window of every metric table.
WINDOW_SIZE = "1 hour"
WINDOW_SLIDE = "15 minutes"

ACTOR = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("login", T.StringType()),
    T.StructField("display_login", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("avatar_url", T.StringType()),
])

REPO = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("url", T.StringType()),
])

ORG = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("login", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("avatar_url", T.StringType()),
])

REPOSITORY_METRICS = T.StructType([
    T.StructField("repo_id", T.LongType()),
    T.StructField("repo_name", T.StringType()),
    T.StructField("stars", T.LongType()),
    T.StructField("forks", T.LongType()),
    T.StructField("watchers", T.LongType()),
    T.StructField("open_issues", T.LongType()),
])

# Wire schema of one JSON event. ``payload`` is an open object: as a
# map<string,string> nested values arrive as JSON text and are decoded on
# demand by the enrichment stage.
EVENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("actor", ACTOR),
    T.StructField("repo", REPO),
    T.StructField("payload", T.MapType(T.StringType(), T.StringType())),
    T.StructField("public", T.BooleanType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("org", ORG),
    T.StructField("collected_at", T.StringType()),
    T.StructField("languages", T.ArrayType(T.StringType())),
    T.StructField("repository_metrics", REPOSITORY_METRICS),
])

# --- fixed values: the payload keys the pipeline reads -----------------------
PAYLOAD_FIELDS = ("action", "commits", "language", "ref_type", "repository")

# The same event with a narrow payload: only the keys enrichment reads, each
# as JSON text. Keys not named here are skipped by the parser, not copied
# into a map; large bodies (pull requests, issues, comments) cost a scan,
# not a string per field.
PAYLOAD_SLIM = T.StructType([T.StructField(f, T.StringType()) for f in PAYLOAD_FIELDS])
EVENT_SLIM = T.StructType([
    T.StructField(f.name, PAYLOAD_SLIM) if f.name == "payload" else f for f in EVENT.fields])

# Transport record: what a message bus (or a landed file) carries.
RECORD = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])

# Clean events between the ingest query and the table queries: only the
# fields the served tables read.
CLEAN_EVENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("actor", T.StructType([T.StructField("id", T.LongType()),
                                         T.StructField("login", T.StringType())])),
    T.StructField("repo", T.StructType([T.StructField("id", T.LongType()),
                                        T.StructField("name", T.StringType())])),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("collected_at", T.TimestampType()),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("public", T.BooleanType()),
    T.StructField("languages", T.ArrayType(T.StringType())),
    # rejected records travel in the same table: errors lists what is missing
    T.StructField("errors", T.StringType()),
    T.StructField("event_key", T.StringType()),
    T.StructField("record_id", T.StringType()),       # of rejected records
])

# --- served tables (the sink contract) --------------------------------------
RAW_EVENTS = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("actor_id", T.LongType()),
    T.StructField("actor_login", T.StringType()),
    T.StructField("repo_id", T.LongType()),
    T.StructField("repo_name", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("collected_at", T.TimestampType()),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("public", T.BooleanType()),
])

_W = [T.StructField("window_start", T.TimestampType()),
      T.StructField("window_end", T.TimestampType())]

REPOSITORY_METRICS_TABLE = T.StructType(
    [T.StructField("repo_id", T.LongType()), T.StructField("repo_name", T.StringType())]
    + _W
    + [T.StructField(c, T.LongType())
       for c in ("event_count", "stars", "forks", "pull_requests", "issues")])

EVENT_TYPE_DISTRIBUTION_TABLE = T.StructType(
    [T.StructField("event_type", T.StringType())] + _W
    + [T.StructField("event_count", T.LongType())])

USER_ACTIVITY_TABLE = T.StructType(
    [T.StructField("user_id", T.LongType()), T.StructField("username", T.StringType())]
    + _W
    + [T.StructField("event_count", T.LongType()),
       T.StructField("repos_contributed", T.LongType()),
       T.StructField("event_types", T.StringType())])

LANGUAGE_TRENDS_TABLE = T.StructType(
    [T.StructField("language", T.StringType())] + _W
    + [T.StructField("event_count", T.LongType())])

REJECTED_EVENTS_TABLE = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("id", "type", "errors", "event_key", "record_id")]
    + [T.StructField("created_at", T.TimestampType())])

SESSION_ACTIVITY_TABLE = T.StructType(
    [T.StructField("user_id", T.LongType()), T.StructField("username", T.StringType())]
    + _W
    + [T.StructField(c, T.LongType()) for c in ("event_count", "pushes", "stars", "forks",
                                                "pull_requests", "issues")]
    + [T.StructField("last_event_at", T.TimestampType())])

USER_REPOSITORIES_TABLE = T.StructType(
    [T.StructField("user_id", T.LongType()), T.StructField("username", T.StringType())]
    + _W
    + [T.StructField("event_count", T.LongType()), T.StructField("repos", T.BinaryType())])

PUSH_THEN_STAR_TABLE = T.StructType(
    [T.StructField("repo_id", T.LongType()), T.StructField("push_id", T.StringType()),
     T.StructField("created_at", T.TimestampType()), T.StructField("star_id", T.StringType()),
     T.StructField("star_at", T.TimestampType())])

TABLE_SCHEMAS = {
    "events": RAW_EVENTS,
    "repository_metrics": REPOSITORY_METRICS_TABLE,
    "event_type_distribution": EVENT_TYPE_DISTRIBUTION_TABLE,
    "user_activity": USER_ACTIVITY_TABLE,
    "language_trends": LANGUAGE_TRENDS_TABLE,
    "rejected_events": REJECTED_EVENTS_TABLE,
    "session_activity": SESSION_ACTIVITY_TABLE,
    "push_then_star": PUSH_THEN_STAR_TABLE,
    "user_repositories": USER_REPOSITORIES_TABLE,
    "dirty_windows": T.StructType(_W),
}

# Columns that the lake stores beside the contract's and reads hide: what a
# rebuild of metric tables from the raw table needs.
TABLE_EXTRA = {
    "events": T.StructType([T.StructField("languages", T.ArrayType(T.StringType()))]),
}

# Unique key of each served table (the repository and user tables also key on
# the name, because the aggregation groups by it: a rename inside one window
# yields two rows).
TABLE_KEYS = {
    "events": ("id",),
    "repository_metrics": ("repo_id", "repo_name", "window_start", "window_end"),
    "event_type_distribution": ("event_type", "window_start", "window_end"),
    "user_activity": ("user_id", "username", "window_start", "window_end"),
    "language_trends": ("language", "window_start", "window_end"),
    "rejected_events": ("record_id",),
    "session_activity": ("user_id", "username", "window_start"),
    "push_then_star": ("push_id", "star_id"),
    "user_repositories": ("user_id", "username", "window_start", "window_end"),
}

# Entity column each table is clustered on inside a date partition; min/max
# statistics on it stand in for the secondary indexes of a row store.
TABLE_CLUSTER = {
    "events": "created_at",
    "repository_metrics": "repo_id",
    "event_type_distribution": "event_type",
    "user_activity": "user_id",
    "language_trends": "language",
    "session_activity": "user_id",
    "push_then_star": "repo_id",
    "user_repositories": "user_id",
}
