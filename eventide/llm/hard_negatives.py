"""Hard-negative mining by Strassen products of integer tiles.

Anchors meet every row in tiles: a block of anchors times a block of rows, both
integer matrices, zero-padded to even halves and multiplied by Strassen's seven
recursive products. Additions of 64-bit integers are exact (they wrap, and a sum
that fits in the end is right), so a score is the exact inner product as long as
that fits 64 bits.

Two passes over the tiles. The first keeps each anchor's best rows of its own
label, its positives; their scores fix a window of negative scores for each, and
the second pass keeps the best rows of other labels inside every window. Both
keep bounded best lists per anchor ("heaps") whose union's best are the best of
all, so tasks work apart and their lists are merged by a top-k per anchor.

Spark's part: blocks of anchors, dealt by hash, are held by tasks, the blocks of
rows are shipped once per anchor block and stream past. The anchors are the
stated queries; no group of rows meets itself otherwise. A task holds one anchor
block, its lists and one tile. Where there are few anchor blocks, the rows of one
are split over ``slices`` tasks.

Defined cases: a null id, label or vector, or one holding a null or non-finite
component, takes no part; missing trailing components count as 0; rows with the
anchor's own id are neither its positives nor its negatives; a repeated row
counts each time it stands there, a repeated anchor asks once, and an anchor id
that stands on different vectors or labels asks for each; equal scores rank by
id; an anchor without positives, and a positive without rows in its window, give
no row; an empty table gives none; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import BLOCK, QUERY_BLOCK, dealt, matrix, met, pack_any, slices_for, usable
from .common import written
from .wordbytes import give_back

TILE = 512                   # anchors in one product
ROW_BLOCK = 2048
LEAF = 16                    # the recursion ends where a side is this short
LEAST = np.iinfo(np.int64).min


# --- products ------------------------------------------------------------------

def _leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    high = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if high < 2.0 ** 53:             # every partial sum is an exact double
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def _strassen(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    if not levels:
        return _leaf(a, b)
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    down = levels - 1
    p1 = _strassen(a11 + a22, b11 + b22, down)
    p2 = _strassen(a21 + a22, b11, down)
    p3 = _strassen(a11, b12 - b22, down)
    p4 = _strassen(a22, b21 - b11, down)
    p5 = _strassen(a11 + a12, b22, down)
    p6 = _strassen(a21 - a11, b11 + b12, down)
    p7 = _strassen(a12 - a22, b21 + b22, down)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out


def _padded(mat: np.ndarray, rows: int, cols: int) -> np.ndarray:
    if mat.shape == (rows, cols):
        return mat
    out = np.zeros((rows, cols), np.int64)
    out[:mat.shape[0], :mat.shape[1]] = mat
    return out


def product(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a @ b of int64 matrices, sides padded with zeros to halve evenly."""
    (m, k), n = a.shape, b.shape[1]
    k = max(k, b.shape[0])
    levels = 0
    while min(m, k, n) >> levels > leaf:
        levels += 1
    m2, k2, n2 = (-(-x >> levels) << levels for x in (m, k, n))
    return _strassen(_padded(a, m2, k2), _padded(b, k2, n2), levels)[:m, :n]


# --- best lists ----------------------------------------------------------------

class Heaps:
    """The k best (score, id) of many slots: higher scores, then smaller ids."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        # what a full slot's last entry holds
        self.bar = np.full(slots, LEAST)
        self.bar_id = np.full(slots, np.iinfo(np.int64).max)

    def offer(self, slot: np.ndarray, score: np.ndarray, vec: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, vec = (np.concatenate(x) for x in (
            (self.slot, slot), (self.score, score), (self.id, vec)))
        order = np.lexsort((vec, -score, slot))
        slot = slot[order]
        first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        keep = rank < self.k
        self.slot, self.score, self.id = slot[keep], score[order][keep], vec[order][keep]
        last = rank[keep] == self.k - 1
        self.bar[self.slot[last]] = self.score[last]
        self.bar_id[self.slot[last]] = self.id[last]


def best_cells(score: np.ndarray, ids: np.ndarray, allowed: np.ndarray, bar: np.ndarray,
               bar_id: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells that can enter their row's list; ``ids`` ascend, at most k a row stay
    (more where scores leave no room to rank ties inside 64 bits)."""
    level = bar[:, None]
    allowed = allowed & ((score > level) | ((score == level) & (ids < bar_id[:, None])))
    many = np.flatnonzero(np.count_nonzero(allowed, axis=1) > k)
    width = score.shape[1]
    if len(many) and np.abs(score[many]).max() < (1 << 62) // (width + 1):
        place = np.where(allowed[many], score[many] * width - np.arange(width), LEAST)
        kth = np.partition(place, width - k, axis=1)[:, width - k]
        allowed[many] &= place >= kth[:, None]
    return np.nonzero(allowed)


# --- passes --------------------------------------------------------------------

class Positives:
    """First pass over one tile's anchors: the best rows of the anchor's label."""

    def __init__(self, row: dict, cut: slice, k: int):
        ids, labels, self.mat = (x[cut] for x in matrix(row))
        self.ids, self.labels = ids[:, None], labels[:, None]
        self.heaps = Heaps(len(ids), k)
        self.key = (row["block"] << 20) + np.arange(cut.start, cut.start + len(ids))

    def offer(self, ids: np.ndarray, labels: np.ndarray, score: np.ndarray) -> None:
        h = self.heaps
        allowed = (labels == self.labels) & (ids != self.ids)
        at, col = best_cells(score, ids, allowed, h.bar, h.bar_id, h.k)
        h.offer(at, score[at, col], ids[col])

    def result(self) -> dict[str, np.ndarray]:
        h = self.heaps
        return {"anchor": self.key[h.slot], "anchor_id": self.ids[h.slot, 0],
                "positive_id": h.id, "positive_score": h.score}


class Negatives:
    """Second pass: for every positive, the best rows of other labels in its window."""

    def __init__(self, row: dict, cut: slice, k: int, low: int, high: int):
        ids, labels, self.mat = (x[cut] for x in matrix(row))
        self.ids, self.labels = ids[:, None], labels[:, None]
        found = [p for p in row["positives"] or [] if cut.start <= p["at"] < cut.start + len(ids)]
        self.found = sorted(found, key=lambda p: (p["nth"], p["at"]))
        self.nth = np.array([p["nth"] for p in self.found], np.int64)
        self.at = np.array([p["at"] - cut.start for p in self.found], np.int64)
        score = np.array([p["score"] for p in self.found], np.int64)
        self.least, self.most = -(-low * score // 100), high * score // 100
        self.heaps = Heaps(len(self.found), k)

    def offer(self, ids: np.ndarray, labels: np.ndarray, score: np.ndarray) -> None:
        h, other = self.heaps, (labels != self.labels) & (ids != self.ids)
        for nth in np.unique(self.nth):
            slot = np.flatnonzero(self.nth == nth)
            at = self.at[slot]
            mine = score[at]
            allowed = (other[at] & (mine >= self.least[slot, None])
                       & (mine <= self.most[slot, None]))
            r, c = best_cells(mine, ids, allowed, h.bar[slot], h.bar_id[slot], h.k)
            h.offer(slot[r], mine[r, c], ids[c])

    def result(self) -> dict[str, np.ndarray]:
        h = self.heaps
        mine = [self.found[s] for s in h.slot.tolist()]
        return {"anchor": np.array([p["anchor"] for p in mine], np.int64),
                "nth": np.array([p["nth"] for p in mine], np.int64),
                "anchor_id": self.ids[self.at[h.slot], 0],
                "positive_id": np.array([p["id"] for p in mine], np.int64),
                "positive_score": np.array([p["score"] for p in mine], np.int64),
                "negative_id": h.id, "negative_score": h.score}


def _tiles(make, names: list[str], tile: int):
    """Anchors of a (block, slice) come first, then the rows stream past them."""
    def run(batches):
        now, held = None, []

        def out():
            for one in held:
                cols = one.result()
                if len(cols[names[0]]):
                    yield pa.RecordBatch.from_pydict(
                        {n: pa.array(cols[n], pa.int64()) for n in names})
            give_back()

        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
                if (row["number"], row["slice"]) != now:
                    yield from out()
                    now, held = (row["number"], row["slice"]), []
                if row["kind"] == 0:
                    held += [make(row, slice(a, a + tile)) for a in range(0, row["n"], tile)]
                    continue
                ids, labels, mat = matrix(row)
                across = np.ascontiguousarray(mat.T)
                for one in held:
                    dim = max(one.mat.shape[1], across.shape[0])
                    one.offer(ids, labels, product(
                        _padded(one.mat, len(one.mat), dim),
                        _padded(across, dim, across.shape[1])))
        yield from out()
    return run


def mine(embeddings: DataFrame, label: Column | None = None, every: int = 100, positives: int = 5,
         negatives: int = 10, low: int = 30, high: int = 90, id_col: str = "vec_id",
         vec_col: str = "embedding", label_col: str = "label", scale: int = 256,
         anchor_block: int = QUERY_BLOCK, row_block: int = ROW_BLOCK,
         tile: int = TILE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the ids divisible by ``every``; ``positives`` rows of the same
    label each, and for each of them the ``negatives`` best rows of other labels
    that score between ``low`` and ``high`` percent of the positive.
    """
    spark = embeddings.sparkSession
    vectors = usable(embeddings, id_col, vec_col,
                     F.col(label_col) if label is None else label, scale)
    rows = written(vectors.mapInArrow(pack_any(row_block), BLOCK), "rows")
    packed, blocks = dealt(vectors.where(F.col("vec_id") % every == 0).distinct(), anchor_block)
    slices = slices_for(spark, blocks)
    anchors = written(packed, "anchors").withColumn("number", F.shiftright("block", 20))

    def passed(asking: DataFrame, make, names: list[str]) -> DataFrame:
        return met(asking, rows, blocks, slices).mapInArrow(
            _tiles(make, names, tile), ", ".join(f"{c} long" for c in names))

    best = passed(anchors, lambda row, cut: Positives(row, cut, positives),
                  ["anchor", "anchor_id", "positive_id", "positive_score"])
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    best = best.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= positives)
    lists = (best.groupBy(F.shiftright("anchor", 20).alias("block"))
             .agg(F.collect_list(F.struct(          # at most a block's anchors times positives
                 "anchor", (F.col("anchor") % (1 << 20)).alias("at"), "nth",
                 F.col("positive_id").alias("id"), F.col("positive_score").alias("score")))
                 .alias("positives")))
    asking = written(anchors.join(lists, "block"), "asking")

    found = passed(asking, lambda row, cut: Negatives(row, cut, negatives, low, high),
                   ["anchor", "nth", "anchor_id", "positive_id", "positive_score",
                    "negative_id", "negative_score"])
    order = Window.partitionBy("anchor", "nth").orderBy(F.desc("negative_score"), "negative_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                    "negative_score"))
