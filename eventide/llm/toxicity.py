"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams.

Features of a text are the distinct hashes of its words, word pairs and
skip-pairs (words two apart); words are runs of ASCII letters and digits
(lower-cased) and non-ASCII characters. Training runs FTRL-proximal with
per-coordinate rates over a bounded, documented sample of labelled rows
(``max_train`` rows with the smallest id hashes); L1 leaves few weights, at
most ``2 ** bits`` by construction, which are broadcast to score every whole
text.

Defined cases: a null or empty text has no features and scores by the bias
alone; rows with a null id are scored, never learnt from, and not held out;
several label rows of an id count once (toxic if any says so); repeated
documents get equal scores; without labels every text scores 0; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import wordbytes as wb
from .common import bounded_ids

BITS = 20
MAX_TRAIN = 12_000
EPOCHS = 20
MIN_DOCS = 3                 # n-grams of fewer sampled texts are not learnt
ALPHA, BETA, L1, L2 = 4.0, 1.0, 15.0, 0.1

_KINDS = np.zeros(256, np.uint8)
_KINDS[48:58] = 1
_KINDS[65:91] = 1
_KINDS[97:123] = 1
_KINDS[128:] = 1


def _features(text: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of every n-gram occurrence of a block."""
    w = wb.words(text, offsets, _KINDS, wb.LOWER)
    row = w.row
    at2, pair = wb.windows(w, 2)
    at3, skip = wb.windows(w, 2, (0, 2))
    slot = np.concatenate([w.hash, pair, skip]) >> np.uint64(64 - bits)
    return np.concatenate([row, row[at2], row[at3]]), slot.astype(np.int64)


def _train(bits: int):
    """One task, at most ``max_train`` rows: their features, then the epochs."""
    def run(batches):
        docs, y = [], []
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for first, text, offsets in wb.blocks(batch.column(0)):
                row, slot = _features(text, offsets, bits)
                at = np.argsort(row, kind="stable")
                cut = np.searchsorted(row[at], np.arange(len(offsets)))
                docs += [np.unique(slot[at[a:b]]).astype(np.int32)
                         for a, b in zip(cut[:-1], cut[1:])]
                y += list(label[first:first + len(offsets) - 1])
        seen = np.zeros(1 << bits, np.int32)
        for at in docs:
            seen[at] += 1
        docs = [at[seen[at] >= MIN_DOCS] for at in docs]
        z, n = np.zeros(1 << bits), np.zeros(1 << bits)
        z0 = n0 = bias = 0.0
        for epoch in range(EPOCHS):
            order = np.random.Generator(np.random.PCG64(epoch)).permutation(len(docs))
            for d in order:
                at = docs[d]
                zd, nd = z[at], n[at]
                w = np.where(np.abs(zd) <= L1, 0.0, (np.sign(zd) * L1 - zd)
                             / ((BETA + np.sqrt(nd)) / ALPHA + L2))
                bias = -z0 / ((BETA + np.sqrt(n0)) / ALPHA)
                g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - y[d]
                z[at] = zd + g - (np.sqrt(nd + g * g) - np.sqrt(nd)) / ALPHA * w
                n[at] = nd + g * g
                z0 += g - (np.sqrt(n0 + g * g) - np.sqrt(n0)) / ALPHA * bias
                n0 += g * g
        w = np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z)
                     / ((BETA + np.sqrt(n)) / ALPHA + L2))
        at, known = np.flatnonzero(w), len(docs)
        del docs
        wb.give_back()
        if known:
            yield pa.RecordBatch.from_pydict({
                "slot": pa.array(np.concatenate([[-1], at]), pa.int64()),
                "weight": pa.array(np.concatenate([[bias], w[at]]), pa.float64())})
    return run


def train(docs: DataFrame, labels: DataFrame, learnable: Column | None = None,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          max_train: int = MAX_TRAIN, bits: int = BITS) -> dict[int, float]:
    """Weights by slot (bias at -1) learnt from labelled rows."""
    seen = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"),
                    F.col(label_col).cast("int").alias("y")))
    if learnable is not None:
        seen = seen.where(learnable)
    chosen = bounded_ids(seen.groupBy("id").agg(F.max("y").alias("y")), max_train)
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # at most max_train ids are broadcast; a repeated document counts once
    sample = (text.join(F.broadcast(chosen), "id")
              .groupBy("id", "y").agg(F.min("text").alias("text")))
    rows = (sample.coalesce(1).sortWithinPartitions(F.xxhash64("id"), "id")
            .select("text", "y").mapInArrow(_train(bits), "slot long, weight double").collect())
    return {r.slot: r.weight for r in rows}


def scorer(spark, weights: dict[int, float], bits: int = BITS):
    """Arrow UDF: the score of each whole text, 0 to 1."""
    dense = np.zeros(1 << bits, np.float32)
    for slot, weight in weights.items():
        if slot >= 0:
            dense[slot] = weight
    held = spark.sparkContext.broadcast((dense, weights.get(-1, -np.inf)))

    def score(column: pa.Array) -> pa.Array:
        dense, bias = held.value
        out = np.full(len(column), bias)
        for first, text, offsets in wb.blocks(column):
            row, slot = _features(text, offsets, bits)
            weight = dense[slot]
            hit = np.flatnonzero(weight)
            if len(hit):
                pair = np.unique(row[hit] * (1 << bits) + slot[hit])
                np.add.at(out, first + (pair >> bits), dense[pair & ((1 << bits) - 1)])
        with np.errstate(over="ignore"):
            return pa.array(1 / (1 + np.exp(-out)), pa.float64())

    return F.arrow_udf(score, "double")


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """True for ids whose crc32 (as text) is divisible by ``folds``; null: false."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0,
                      F.lit(False))


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = train(docs, labels, ~held_out("id"), id_col, text_col)
    score = scorer(docs.sparkSession, model)
    return (docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                        score(F.col(text_col)).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The documents not predicted toxic, with all their columns."""
    score = scorer(docs.sparkSession, train(docs, labels, ~held_out("id"), id_col, text_col))
    return docs.where(score(F.col(text_col)) < 0.5)
