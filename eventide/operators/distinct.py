"""True numbers of distinct repositories per user over many windows (V3).

Summed per-window counts count a repository once per window. Two mergeable forms
don't: a distinct sketch per (user, hour), stored like any metric and united at
read time, and the exact pairs. Both are folded before each shuffle, so a user
with a third of all events leaves a task as one sketch, or one row per
repository.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .metrics import event_window, flatten_window

LG_K = 12
# three standard errors of a sketch with 2 ** LG_K slots (1.04 / sqrt(2 ** LG_K) each);
# below about 2 ** LG_K / 8 values the sketch holds the values' hashes themselves
SKETCH_ERROR = 3 * 1.04 / 2 ** (LG_K / 2)

USER = ("user_id", "username")


def user_repository_sketches(df: DataFrame, size: str = "1 hour") -> DataFrame:
    """Per user and window (one after the other): events and a sketch of the
    repositories touched; batch or, with a watermark, stream."""
    return flatten_window(
        df.groupBy(F.col("actor.id").alias("user_id"), F.col("actor.login").alias("username"),
                   event_window(size, size).alias("window"))
        .agg(F.count(F.lit(1)).alias("event_count"),
             F.hll_sketch_agg(F.col("repo.id"), LG_K).alias("repos")))


def sketched_repositories(stored: DataFrame) -> DataFrame:
    """Distinct repositories per user over all given windows, from their sketches."""
    return (stored.groupBy(*USER)
            .agg(F.sum("event_count").alias("total_events"),
                 F.hll_sketch_estimate(F.hll_union_agg("repos")).alias("distinct_repos")))


def exact_repositories(df: DataFrame) -> DataFrame:
    """Distinct repositories per user, exactly: counts per (user, repository), then
    per user."""
    pairs = (df.groupBy(F.col("actor.id").alias("user_id"), F.col("actor.login").alias("username"),
                        F.col("repo.id").alias("repo_id"))
             .agg(F.count(F.lit(1)).alias("n")))
    return (pairs.groupBy(*USER).agg(F.sum("n").alias("total_events"),
                                     F.count("repo_id").alias("distinct_repos")))
