"""Contiguous shards of near-equal byte size (global prefix sums).

Rows are put in one global order by a range shuffle of small records (id,
size, checksum; never the text). Each range partition reports its byte and
row totals; the running sums over these few totals, added to the running sums
inside a partition, give every row its global byte position. Cutting the byte
axis at equal targets, by the middle of each row, gives shards whose size
differs from the target by less than the longest row.

Defined cases: a null text has size 16 and checksum 0, like an empty one;
null ids come first; repeated rows and ties are ordered by checksum and size
and are interchangeable beyond that; an empty table gives no rows; other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

OVERHEAD = 16


def balanced_shards(docs: DataFrame, shards: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard."""
    data = F.col(text_col).cast("binary")
    small = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(data), F.lit(0)).cast("long") + OVERHEAD).alias("size"),
        F.coalesce(F.crc32(data), F.lit(0)).cast("long").alias("text_crc32"))
    order = ["doc_id", "text_crc32", "size"]
    # the written copy fixes which partition each row is in, also for retries
    placed = written(
        small.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("pid", F.spark_partition_id()), "ranges")

    totals = placed.groupBy("pid").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    # one row per partition: the only step that sees all of them at once
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    base = totals.select(
        "pid",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(everything).alias("total"))

    inside = Window.partitionBy("pid").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    at = placed.select(
        "*", F.sum("size").over(inside).alias("bytes_upto"),
        F.count("*").over(inside).alias("rank"))
    cut = at.join(base, "pid").select(
        *order, (F.col("rows_before") + F.col("rank") - 1).alias("row"),
        # twice the byte position of the row's middle, against twice the total
        F.expr(f"least({shards} - 1, (2 * (bytes_before + bytes_upto) - size) * {shards}"
               " div (2 * total))").cast("int").alias("shard"))
    first = cut.groupBy("shard").agg(F.min("row").alias("first"))   # at most `shards` rows
    return cut.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("row") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
