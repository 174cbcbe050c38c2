"""Exact top-k inner-product search with multi-resolution segment statistics.

A vector's segments are summarised by mean and deviation. For two vectors,
``sum(width * (mean_q * mean_x + dev_q * dev_x))`` over the segments is an
upper bound of the inner product (equivalently, ``sum(width * ((mean_q -
mean_x)^2 + (dev_q - dev_x)^2))`` is a lower bound of the squared distance).
Coarse segments are cheap to compare and finer ones closer to the truth: a
query's candidates pass the resolutions from coarse to fine, those whose bound
falls below the query's k-th best score so far leave, and the survivors get
exact integer scores. Nothing is approximate.

Spark packs vectors into blocks. Tasks hold blocks of queries, and the rows'
blocks are shipped once per query block and stream past it (``blocks``); a top-k
window per query merges the tasks' best lists. A task holds one query block, its
lists and one tile. Blocks of rows are not pruned as a whole: on vectors without
clusters no bound of a block is below any query's bar.

Defined cases: a null vector, or one holding a null or non-finite component,
takes no part; missing trailing components count as 0 and an empty vector as
all zeros; a null id takes no part; a row is never a candidate of a query with
its own id; a repeated row is a candidate of its own, repeated query rows ask
once; where a query id stands on rows with different vectors, all of them ask
and a candidate row counts with its best score; equal scores rank by id; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import BLOCK, QUERY_BLOCK, dealt, matrix, met, pack_any, slices_for, usable
from .common import written
from .wordbytes import give_back

TILE = 1024                  # queries that meet a block of rows at a time
ROW_BLOCK = 2048
RESOLUTIONS = (4, 16)        # segments per vector, coarse to fine
SEEDS = 16                   # candidates scored exactly to start a query's bar

def segment_stats(mat: np.ndarray, segments: int) -> np.ndarray:
    """Rows of sqrt(width) * (means, deviations), so bounds are dot products."""
    width = mat.shape[1] // segments
    cut = mat.reshape(len(mat), segments, width)
    return np.concatenate([cut.mean(2), cut.std(2)], axis=1) * np.sqrt(width)


def _padded(mat: np.ndarray, dim: int) -> np.ndarray:
    dim = -(-max(dim, 1) // RESOLUTIONS[-1]) * RESOLUTIONS[-1]
    out = np.zeros((len(mat), dim))
    out[:, :mat.shape[1]] = mat
    return out


class BestOfBlock:
    """Running best lists of the queries of one block."""

    def __init__(self, ids: np.ndarray, mat: np.ndarray, k: int):
        self.ids, self.mat, self.k = ids, mat, k
        # candidate id, score, candidate row
        self.best = [(np.zeros(0, np.int64),) * 3 for _ in ids]

    def _exact(self, q: int, ids: np.ndarray, mat: np.ndarray, at: np.ndarray, safe: bool,
               block: int) -> None:
        if safe:      # every product and sum is an integer below 2 ** 53
            score = (mat[at] @ self._queries[q]).astype(np.int64)
        else:
            score = mat[at].astype(np.int64) @ self._queries[q].astype(np.int64)
        vec = np.concatenate([self.best[q][0], ids[at]])
        score = np.concatenate([self.best[q][1], score])
        row = np.concatenate([self.best[q][2], block * ROW_BLOCK + at])
        top = np.lexsort((vec, -score))[:self.k]
        self.best[q] = vec[top], score[top], row[top]

    def offer(self, block: int, ids: np.ndarray, mat: np.ndarray) -> None:
        dim = max(mat.shape[1], self.mat.shape[1])
        self._queries, rows = _padded(self.mat, dim), _padded(mat, dim)
        high = np.abs(rows).max(initial=0) * np.abs(self._queries).max(initial=0) * rows.shape[1]
        safe, slack = high < 2.0 ** 52, 1e-9 * high + 1e-6
        stats = [(segment_stats(self._queries, s), segment_stats(rows, s)) for s in RESOLUTIONS]
        coarse = stats[0][0] @ stats[0][1].T + slack
        for q, bound in enumerate(coarse):
            bound[ids == self.ids[q]] = -np.inf
            if len(self.best[q][0]) < self.k:      # no bar yet: score the likeliest
                seeds = (np.argpartition(-bound, SEEDS)[:SEEDS] if len(bound) > SEEDS
                         else np.arange(len(bound)))
                seeds = seeds[bound[seeds] > -np.inf]
                self._exact(q, ids, rows, seeds, safe, block)
                bound[seeds] = -np.inf
            bar = self.best[q][1][-1] if len(self.best[q][0]) == self.k else -np.inf
            left = np.flatnonzero((bound >= bar) & (bound > -np.inf))
            for mine, theirs in stats[1:]:
                if len(left):
                    left = left[theirs[left] @ mine[q] + slack >= bar]
            if len(left):
                self._exact(q, ids, rows, left, safe, block)


def _search(k: int):
    """Queries of a (number, slice) come first, then the rows stream past them."""
    def run(batches):
        now, held = None, []

        def out():
            for best in held:
                query = np.repeat(best.ids, [len(x[0]) for x in best.best])
                if len(query):
                    yield pa.RecordBatch.from_pydict({
                        "query_id": pa.array(query, pa.int64()),
                        **{name: pa.array(np.concatenate([x[c] for x in best.best]), pa.int64())
                           for c, name in enumerate(("vec_id", "score", "row"))}})
            give_back()

        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
                if (row["number"], row["slice"]) != now:
                    yield from out()
                    now, held = (row["number"], row["slice"]), []
                ids, _, mat = matrix(row)
                if row["kind"] == 0:
                    held += [BestOfBlock(ids[a:a + TILE], mat[a:a + TILE], k)
                             for a in range(0, len(ids), TILE)]
                else:
                    for best in held:
                        best.offer(row["block"], ids, mat)
        yield from out()
    return run


def exact_topk(embeddings: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id",
               vec_col: str = "embedding", scale: int = 256,
               query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products."""
    vectors = usable(embeddings, id_col, vec_col, F.lit(0), scale)
    rows = written(vectors.mapInArrow(pack_any(ROW_BLOCK), BLOCK), "rows")
    packed, blocks = dealt(vectors.where(F.col("vec_id") % every == 0).distinct(), query_block)
    queries = written(packed, "queries").withColumn("number", F.shiftright("block", 20))
    met_ = met(queries, rows, blocks, slices_for(embeddings.sparkSession, blocks))
    found = (met_.mapInArrow(_search(k), "query_id long, vec_id long, score long, row long")
             .groupBy("query_id", "vec_id", "row").agg(F.max("score").alias("score")))

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
