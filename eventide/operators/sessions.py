"""Session windows: a user's events with no pause longer than a gap.

One function for batches and streams. A stream hands every event to
``session_window``; its state holds one merged session per open user and is
closed by the watermark. A batch first folds events into slots as wide as the
gap (two events of one slot always share a session), a hash aggregate that is
combined before the shuffle; a user with a third of all events leaves it as one
row per slot. The slots' spans are then merged by ``session_window`` with a
dynamic gap, so that sorting and merging never sees single events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefilters import width_micros
from .temporal import slot

SESSION_GAP = "30 minutes"
# event types that a session counts apart
COUNTED = {"pushes": "PushEvent", "stars": "WatchEvent", "forks": "ForkEvent",
           "pull_requests": "PullRequestEvent", "issues": "IssuesEvent"}


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("event_count", *COUNTED)]


def single_spans(df: DataFrame) -> DataFrame:
    """Every event as a span of its own."""
    return df.select(
        F.col("actor.id").alias("user_id"), F.col("actor.login").alias("username"),
        F.col("created_at").alias("first_at"), F.col("created_at").alias("last_at"),
        F.lit(1).cast("long").alias("event_count"),
        *[(F.col("type") == t).cast("long").alias(c) for c, t in COUNTED.items()])


def slot_spans(df: DataFrame, gap: str = SESSION_GAP) -> DataFrame:
    """A user's events per slot of the gap's width, as one span each."""
    spot = slot(F.col("first_at"), width_micros(gap))
    return (single_spans(df).groupBy("user_id", "username", spot.alias("slot"))
            .agg(F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"), *_sums())
            .drop("slot"))


def session_activity(df: DataFrame, gap: str = SESSION_GAP) -> DataFrame:
    """Per user and session: its bounds (``window_end`` is the gap after the last
    event), events, events of the counted types, and the last event's time.

    On a stream, put ``withWatermark("created_at", ...)`` before; a session is
    emitted once the watermark passes its end.
    """
    if df.isStreaming:
        spans, session = single_spans(df), F.session_window("first_at", gap)
    else:
        spans = slot_spans(df, gap)
        micros = F.unix_micros("last_at") - F.unix_micros("first_at") + F.lit(width_micros(gap))
        session = F.session_window("first_at", F.make_interval(
            secs=(micros / 1_000_000).cast("decimal(18,6)")))
    return (spans.groupBy("user_id", "username", session.alias("session"))
            .agg(F.max("last_at").alias("last_event_at"), *_sums())
            .select("user_id", "username", F.col("session.start").alias("window_start"),
                    F.col("session.end").alias("window_end"), "event_count", *COUNTED,
                    "last_event_at"))
