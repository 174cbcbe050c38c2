"""Joins by time: followed-by, as-of and interval joins.

None of them sorts or joins a key as a whole. Each deals its rows by (key, slot
of time), so that a repository with a third of all events is as many groups as
it has slots, and compares exact times inside the slots.

Defined cases, all joins: null keys and null times match nothing (an as-of or
outer join keeps such a left row, without values); equal rows are separate rows;
an interval that doesn't end after its start holds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefilters import width_micros


def slot(time: Column, micros: int) -> Column:
    """The start of the time's slot, in microseconds."""
    at = F.unix_micros(time)
    return at - F.pmod(at, F.lit(micros))


# --- followed by (stream-stream or batch) ----------------------------------------

def followed_by(left: DataFrame, right: DataFrame, keys: list[str], left_time: str,
                right_time: str, within: str, how: str = "inner") -> DataFrame:
    """Pairs of a left row and a right row of the same ``keys`` at the same time or
    up to ``within`` after it. The sides share only the key columns' names.

    Works on two batches and on two streams; on streams both need a watermark on
    their time, and the state keeps a row no longer than ``within`` plus the
    watermark's delay (``how="left_outer"`` emits a left row without a partner
    once, when its time has passed). A right row is copied to the slot of its time
    and the one before, a left row stays in its own, so a pair meets once.
    """
    size = width_micros(within)
    here = slot(F.col(right_time), size)
    to = [f"_right_{k}" for k in keys]
    right = right.select(*[F.col(k).alias(n) for k, n in zip(keys, to)],
                         *[c for c in right.columns if c not in keys],
                         F.explode(F.array(here, here - size)).alias("_right_slot"))
    left = left.withColumn("_slot", slot(F.col(left_time), size))
    on = F.col("_slot") == F.col("_right_slot")
    for k, n in zip(keys, to):
        on = on & (F.col(k) == F.col(n))
    on = (on & (F.col(right_time) >= F.col(left_time))
          & (F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {within}")))
    return left.join(right, on, how).drop("_slot", "_right_slot", *to)


def push_then_star(df: DataFrame, within: str = "1 hour", how: str = "inner") -> DataFrame:
    """Pushes with the stars that their repository gets up to ``within`` later
    (``created_at`` is the push's time); batch or, with a watermark, stream."""
    def side(kind: str, who: str, when: str) -> DataFrame:
        return df.where(F.col("type") == kind).select(
            F.col("repo.id").alias("repo_id"), F.col("id").alias(who),
            F.col("created_at").alias(when))
    return followed_by(side("PushEvent", "push_id", "created_at"),
                       side("WatchEvent", "star_id", "star_at"),
                       ["repo_id"], "created_at", "star_at", within, how)


# --- as of ----------------------------------------------------------------------

def as_of_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str,
               right_time: str, values: list[str], tie: str, span: str = "1 day",
               inclusive: bool = False) -> DataFrame:
    """Every left row with the ``values`` of the last right row of its keys before
    it (``inclusive``: or at its time); null where there is none. Of right rows at
    one time the one with the greatest ``tie`` counts.

    Time is cut into spans. A map-side aggregate finds each (key, span)'s last
    right row; a window over these few rows carries them to later spans that have
    rows. Inside a span one window hands the last value on, starting from the
    carried one. The only full shuffle deals rows by (key, span); no join.
    """
    size = width_micros(span)
    found = F.struct(*[F.col(v) for v in values], F.col(right_time).alias("_at"))
    known = (right.where(F.col(right_time).isNotNull())
             .select(*keys, F.col(right_time).alias("_time"), F.col(tie).alias("_tie"),
                     found.alias("_value")))
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    known = known.withColumn("_span", slot(F.col("_time"), size))
    asking = left.withColumn("_span", slot(F.col(left_time), size))

    last = known.groupBy(*keys, "_span").agg(
        F.max_by("_value", F.struct("_time", "_tie")).alias("_value"))
    spans = (asking.select(*keys, "_span").distinct()
             .unionByName(last, allowMissingColumns=True)
             .groupBy(*keys, "_span").agg(F.first("_value", ignorenulls=True).alias("_value")))
    earlier = (Window.partitionBy(*keys).orderBy("_span")
               .rowsBetween(Window.unboundedPreceding, -1))
    carried = (spans.select(*keys, "_span", F.last("_value", ignorenulls=True).over(earlier)
                            .alias("_value"))
               .where(F.col("_value").isNotNull()))

    # in a span: what is carried, then right rows by time and tie; left rows of the
    # same time stand before them, or behind them where that counts
    rows = (asking.withColumns({"_time": F.col(left_time), "_side": F.lit(2 if inclusive else 0)})
            .unionByName(known.withColumn("_side", F.lit(1)), allowMissingColumns=True)
            .unionByName(carried.withColumn("_side", F.lit(-1)), allowMissingColumns=True))
    order = (Window.partitionBy(*keys, "_span")
             .orderBy(F.col("_side") != -1, "_time", "_side", "_tie")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = rows.withColumn("_last", F.last("_value", ignorenulls=True).over(order))
    return (out.where(F.col("_side") == (2 if inclusive else 0))
            .select(*[F.col(c) for c in left.columns],
                    *[F.col(f"_last.{v}").alias(v) for v in values],
                    F.col("_last._at").alias(f"{right_time}_as_of")))


# --- intervals ------------------------------------------------------------------

BASE = "15 minutes"          # the finest slots
GROWTH = 4                   # each level's slots are so many times wider
LEVELS = 16                  # the widest are over 30,000 years


def interval_join(points: DataFrame, intervals: DataFrame, time: str, start: str, end: str,
                  keys: list[str] = (), base: str = BASE) -> DataFrame:
    """Every point with every interval ``[start, end)`` that holds its time (and has
    its ``keys``). The sides share only the key columns' names.

    An interval belongs to the finest level whose slots are at least as wide as it
    is, so it lies in one or two of them; a point looks into its slot of each level
    that occurs (one row per level, at most ``LEVELS``). The join is on (keys, level,
    slot), a filter on exact times follows; a pair meets in one slot.
    """
    widths = [width_micros(base) * GROWTH ** k for k in range(LEVELS)]
    size = F.unix_micros(end) - F.unix_micros(start)
    level = F.size(F.filter(F.array(*[F.lit(w) for w in widths[:-1]]), lambda w: w < size))
    width = F.element_at(F.array(*[F.lit(w) for w in widths]), F.col("_level") + 1)

    def place(micros: Column) -> Column:
        return micros - F.pmod(micros, F.col("_width"))

    covers = (intervals.where(F.col(start) < F.col(end)).withColumn("_level", level)
              .withColumn("_width", width)
              .withColumn("_slot", F.explode(F.sequence(
                  place(F.unix_micros(start)), place(F.unix_micros(end) - 1), F.col("_width"))))
              .drop("_width"))
    used = sorted(r[0] for r in covers.select("_level").distinct().collect())   # <= LEVELS numbers
    to = [f"_of_{k}" for k in keys]
    covers = covers.withColumnsRenamed(dict(zip(keys, to)))
    places = F.array(*[F.struct(F.lit(k).alias("_at_level"),
                                slot(F.col(time), widths[k]).alias("_at_slot"))
                       for k in used or [0]])
    on = (F.col("_at_level") == F.col("_level")) & (F.col("_at_slot") == F.col("_slot"))
    for k, n in zip(keys, to):
        on = on & (F.col(k) == F.col(n))
    return (points.select("*", F.inline(places)).join(covers, on)
            .where((F.col(time) >= F.col(start)) & (F.col(time) < F.col(end)))
            .drop("_at_level", "_at_slot", "_level", "_slot", *to))
