"""Blocks of integer vectors, and blocks of queries beside blocks of rows.

Vectors travel as packed blocks of the narrowest integers that hold them. Queries
are dealt by hash into numbered blocks that tasks hold; the rows' blocks are
shipped once per query block and stream past it. There is no join, so nothing is
broadcast, whatever Spark makes of the sizes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUERY_BLOCK = 8192           # queries that a task holds
BLOCK = "block long, n int, dim int, bits int, ids binary, labels binary, vectors binary"


def usable(df: DataFrame, id_col: str, vec_col: str, label: Column, scale: int) -> DataFrame:
    """(vec_id, label, v) of the rows that take part; v = floor(scale * component)."""
    ok = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                  & (F.abs(x.cast("double")) < float("inf")))
    return (df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & ok)
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    label.cast("long").alias("label"),
                    F.transform(F.col(vec_col), lambda x: F.floor(
                        F.lit(scale) * x.cast("double")).cast("long")).alias("v"))
            .where(F.col("label").isNotNull()))


def block(key: int, rows: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    rows = sorted(rows, key=lambda r: r[0])
    dim = max(len(v) for _, _, v in rows)
    mat = np.zeros((len(rows), dim), np.int64)
    for r, (_, _, v) in enumerate(rows):
        mat[r, :len(v)] = v
    high = max(int(mat.max(initial=0)), -int(mat.min(initial=0)) - 1)
    bits = 16 if high < 1 << 15 else 32 if high < 1 << 31 else 64
    return pa.RecordBatch.from_pydict({
        "block": pa.array([key], pa.int64()), "n": pa.array([len(rows)], pa.int32()),
        "dim": pa.array([dim], pa.int32()), "bits": pa.array([bits], pa.int32()),
        "ids": pa.array([np.array([r[0] for r in rows], np.int64).tobytes()], pa.binary()),
        "labels": pa.array([np.array([r[1] for r in rows], np.int64).tobytes()], pa.binary()),
        "vectors": pa.array([mat.astype(f"int{bits}").tobytes()], pa.binary())})


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
    ids, labels = batch.column("vec_id").to_pylist(), batch.column("label").to_pylist()
    vecs = batch.column("v")
    at, flat = vecs.offsets.to_numpy(), vecs.values.to_numpy()
    return zip(ids, labels, (flat[a:b] for a, b in zip(at[:-1], at[1:])))


def pack_any(size: int):
    """Blocks of the rows as they come, numbered by partition."""
    def run(batches):
        part, seq, held = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            held += rows_of(batch)
            while len(held) >= size:
                yield block((part << 32) + seq, held[:size])
                seq, held = seq + 1, held[size:]
        if held:
            yield block((part << 32) + seq, held)
    return run


def pack_dealt(size: int):
    """Blocks of the queries of one number; rows come sorted by it."""
    def run(batches):
        now, seq, held = None, 0, []
        for batch in batches:
            for number, row in zip(batch.column("number").to_pylist(), rows_of(batch)):
                if held and (number != now or len(held) == size):
                    yield block((now << 20) + seq, held)
                    seq, held = seq + 1, []
                if number != now:
                    now, seq = number, 0
                held.append(row)
        if held:
            yield block((now << 20) + seq, held)
    return run


def matrix(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vectors = np.frombuffer(row["vectors"], f"int{row['bits']}").reshape(row["n"], row["dim"])
    return (np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64),
            vectors.astype(np.int64))


def dealt(asked: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Blocks of distinct queries (vec_id, label, v) with their ``number``, and how
    many numbers there are."""
    blocks = max(1, -(-asked.count() // size))
    rows = (asked.withColumn("number", F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(blocks)))
            .repartition("number").sortWithinPartitions("number", "vec_id", "label", "v"))
    return rows.mapInArrow(pack_dealt(size), BLOCK), blocks


def slices_for(spark, blocks: int) -> int:
    """Layout only: tasks per query block, where these alone would be too few."""
    return max(1, -(-3 * spark.sparkContext.defaultParallelism // blocks))


def met(queries: DataFrame, rows: DataFrame, blocks: int, slices: int) -> DataFrame:
    """Every row block beside every query block, sorted: the queries of a
    (number, slice) come first, then the rows stream past them."""
    queries = (queries.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
               .withColumn("kind", F.lit(0)))
    rows = (rows.withColumn("slice", F.pmod(F.xxhash64("block"), F.lit(slices)).cast("int"))
            .withColumn("kind", F.lit(1))
            .withColumn("number", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
            .withColumn("number", F.col("number").cast("long")))
    return (queries.unionByName(rows, allowMissingColumns=True)
            .repartition(max(1, blocks * slices), "number", "slice")
            .sortWithinPartitions("number", "slice", "kind", "block"))
