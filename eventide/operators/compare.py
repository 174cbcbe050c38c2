"""Multiset comparison of two tables: checksums per date, then rows.

Each side is folded, before its only shuffle, into one row per date: how many
rows, and two sums over the rows' hashes (a sum sees repeated rows, which an
exclusive or would cancel). Only dates whose checksums differ are compared row by
row, by counting equal rows on either side; a hot date or row leaves each task as
one row per distinct row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def checksums(df: DataFrame, columns: list[str], date: Column) -> DataFrame:
    """Per date: rows and order-free checksums of the given columns."""
    spot = F.xxhash64(*columns)
    other = F.xxhash64(F.lit("second"), *columns)
    wide = "decimal(38,0)"
    return (df.groupBy(date.alias("date"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(spot.cast(wide)).alias("a"),
                 F.sum(other.cast(wide)).alias("b")))


def differing_dates(left: DataFrame, right: DataFrame, columns: list[str],
                    date: Column) -> list[dt.date | None]:
    """The dates whose checksums differ or that only one side has (one per day)."""
    l, r = (checksums(x, columns, date).withColumnsRenamed(
        {c: f"{p}_{c}" for c in ("date", "n", "a", "b")}) for x, p in ((left, "l"), (right, "r")))
    same = F.lit(True)
    for c in ("n", "a", "b"):
        same = same & F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}"))
    found = (l.join(r, F.col("l_date").eqNullSafe(F.col("r_date")), "full_outer").where(~same)
             .select(F.coalesce("l_date", "r_date").alias("date")).collect())
    return sorted((x[0] for x in found), key=str)


def differences(left: DataFrame, right: DataFrame, date: Column,
                columns: list[str] | None = None) -> DataFrame:
    """Rows that one table holds more often than the other: the columns, ``side``
    (``left`` or ``right``) and ``copies`` (how many more). Equal tables read their
    columns once and compare no row."""
    columns = columns or left.columns
    dates = differing_dates(left, right, columns, date)
    days = [d for d in dates if d is not None]
    hit = F.lit(False)
    if days:
        hit = hit | date.isin(days)
    if None in dates:
        hit = hit | date.isNull()
    both = (left.where(hit).select(*columns, F.lit(1).alias("_more"))
            .unionByName(right.where(hit).select(*columns, F.lit(-1).alias("_more"))))
    return (both.groupBy(*columns).agg(F.sum("_more").alias("_more")).where("_more <> 0")
            .select(*columns, F.when(F.col("_more") > 0, "left").otherwise("right").alias("side"),
                    F.abs("_more").alias("copies")))
