"""Quality rules: exact text statistics and a target/raw likelihood ratio.

Two multinomials over hashed unigrams and bigrams are compared: the trusted
target (documents labelled good) and the raw corpus (every document). A
document's mean log ratio per n-gram says which of the two it resembles; a
fixed threshold decides, with no random choice, so a document's verdict
depends on its text only. Tokens are runs of letters and digits (lower-cased)
and runs of other non-white characters, so markup debris is visible.

Counts of both cover every whole text: an ordinary join by id brings the label
to the text, tasks add up their own ``BUCKETS`` counters and one small
aggregate adds the tasks.

Threshold: the value that best separates good from bad texts which pass the
base rules, but never above the ``KEEP`` quantile of the good ones less
``MARGIN`` times their spread. It is read from one histogram of the scores of
all labelled rows (``BINS`` bins over the range of the ratios), so its
resolution is one bin and no row is left out. Without good or bad texts nothing
is rejected by the ratio.

Defined cases: a null or empty text has no words, ratio 0, and fails the base
rule; several label rows of an id count once (bad if any says so); repeated
documents get equal verdicts; an empty table gives no rows; only the id and
text columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import wordbytes as wb
from .common import written

BUCKETS = 1 << 14
BINS = 1 << 16
KEEP, MARGIN = 0.001, 0.25
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

_WORD = 1 - wb.separators(wb.WHITE).astype(np.uint8)          # words of the base rules
_SYMBOL = wb.separators(b"#*$%&|<>")
_CONTINUES = np.array([b & 0xC0 == 0x80 for b in range(256)])
_TOKEN = np.where(_WORD == 0, 0, 2).astype(np.uint8)          # 1 letters and digits, 2 the rest
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _TOKEN[_a:_b] = 1

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _buckets(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every unigram and bigram of a block."""
    w = wb.words(text, offsets, _TOKEN, wb.LOWER)
    row = w.row
    at, pair = wb.windows(w, 2)
    slot = np.concatenate([w.hash, pair]) >> np.uint64(64 - BUCKETS.bit_length() + 1)
    return np.concatenate([row, row[at]]), slot.astype(np.int64)


# ---- base rules ------------------------------------------------------------

def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(wb.WHITE)]
    return len(lines) - len(set(lines))


def base_block(text: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each row."""
    w = wb.words(text, offsets, _WORD)
    raw = text.tobytes()
    repeat = np.zeros(w.rows, np.int64)
    at, gram = wb.windows(w, 3)
    if len(at):
        row = w.row[at]
        order = np.lexsort((gram, row))
        same = np.zeros(len(order) + 1, bool)
        same[1:-1] = (gram[order][1:] == gram[order][:-1]) & (row[order][1:] == row[order][:-1])
        twice = at[order[same[:-1] | same[1:]]]
        covered = np.zeros(len(w.hash), bool)
        for step in range(3):
            covered[twice + step] = True
        repeat = _sums(covered, w.first)
    return [np.diff(w.first), _sums((_WORD[text] == 1) & ~_CONTINUES[text], offsets),
            _sums(_SYMBOL[text], offsets),
            np.array([_dup_lines(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], np.int64),
            repeat]


# ---- corpus counts -----------------------------------------------------------

def _count(batches):
    raw, target, seen = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64), False
    for batch in batches:
        good = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False) == 1
        for first, text, offsets in wb.blocks(batch.column(0)):
            row, slot = _buckets(text, offsets)
            raw += np.bincount(slot, minlength=BUCKETS)
            target += np.bincount(slot[good[first + row]], minlength=BUCKETS)
            seen = True
    if seen:
        yield pa.RecordBatch.from_pydict({
            "bucket": pa.array(np.arange(BUCKETS), pa.int32()),
            "raw": pa.array(raw, pa.int64()), "target": pa.array(target, pa.int64())})


def _means(column: pa.Array, ratio: np.ndarray) -> np.ndarray:
    out = np.zeros(len(column))
    for first, text, offsets in wb.blocks(column):
        row, slot = _buckets(text, offsets)
        n = len(offsets) - 1
        total = np.bincount(row, ratio[slot], n)
        out[first:first + n] = total / np.maximum(np.bincount(row, minlength=n), 1)
    return out


@dataclass
class RatioModel:
    """Log ratio per bucket (``BUCKETS`` floats, broadcast) and the threshold."""

    ratio: np.ndarray
    threshold: float

    def score(self, spark):
        held = spark.sparkContext.broadcast(self.ratio)
        return F.arrow_udf(lambda c: pa.array(_means(c, held.value), pa.float64()), "double")


def choose_threshold(value: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """Threshold from how many good and bad texts have each of the rising values."""
    n_good, n_bad = good.sum(), bad.sum()
    if not n_good or not n_bad:
        return -np.inf
    # bad texts at or above a value, plus good ones below it, weighed by group
    tries = np.concatenate([[-np.inf], (value[1:] + value[:-1]) / 2])
    lost = (np.cumsum(good) - good) / n_good
    passed = 1 - (np.cumsum(bad) - bad) / n_bad
    best = tries[np.argmin(10 * lost + passed)]
    rank = KEEP * (n_good - 1)
    low, high = (value[np.searchsorted(np.cumsum(good), k, "right")]
                 for k in (int(rank), min(int(rank) + 1, n_good - 1)))
    mean = (good * value).sum() / n_good
    spread = np.sqrt((good * (value - mean) ** 2).sum() / n_good)
    return float(min(best, low + (rank - int(rank)) * (high - low) - MARGIN * spread))


def _labelled(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(id, good): one row per labelled id."""
    return (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("good"))
            .groupBy("id").agg(F.min("good").cast("int").alias("good")))


def _ratios(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str,
            label_col: str) -> RatioModel:
    """Log ratios from the counts of all documents and of all good ones."""
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # labels grow with the documents: one plan at every size, no broadcast; rows without
    # an id match no label and would meet in one task of the join
    joined = (text.where("id is not null")
              .join(_labelled(labels, id_col, label_col).hint("merge"), "id", "left")
              .select("text", "good")
              .unionByName(text.where("id is null")
                           .select("text", F.lit(None).cast("int").alias("good"))))
    counts = (joined.mapInArrow(_count, "bucket int, raw long, target long")
              .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts.collect():           # BUCKETS rows
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    if not target.sum():
        return RatioModel(np.zeros(BUCKETS), -np.inf)
    # one pseudo-count spread over the target by the raw shares: unseen buckets shrink to raw
    p_raw = (raw + 1) / (raw.sum() + BUCKETS)
    prior = 0.01 * target.sum()
    p_target = (target + prior * p_raw) / (target.sum() + prior)
    return RatioModel(np.log(p_target) - np.log(p_raw), -np.inf)


def _scored(docs: DataFrame, model: RatioModel, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, b, mean_log_ratio) of every document."""
    return docs.select(F.col(id_col).alias("doc_id"), base_udf()(F.col(text_col)).alias("b"),
                       model.score(docs.sparkSession)(F.col(text_col)).alias("mean_log_ratio"))


def _threshold(scored: DataFrame, model: RatioModel, labels: DataFrame, id_col: str,
               label_col: str) -> float:
    """Threshold from the scores of all labelled rows that pass the base rules."""
    low, high = float(model.ratio.min()), float(model.ratio.max())
    if low == high:
        return -np.inf
    step = (high - low) / BINS
    rows = (scored.where(F.col("doc_id").isNotNull() & ~failed(F.col("b")))
            .groupBy(F.col("doc_id").cast("long").alias("id"),
                     F.floor((F.col("mean_log_ratio") - low) / step).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"))
            .join(_labelled(labels, id_col, label_col), "id").groupBy("bin")
            .agg(F.sum(F.when(F.col("good") == 1, F.col("n")).otherwise(0)).alias("good"),
                 F.sum(F.when(F.col("good") == 0, F.col("n")).otherwise(0)).alias("bad"))
            .orderBy("bin").collect())                  # about BINS rows at most
    at, good, bad = (np.array([r[k] for r in rows], np.int64) for k in ("bin", "good", "bad"))
    return choose_threshold(low + (at + 0.5) * step, good, bad)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> RatioModel:
    """Counts of all documents, target counts and threshold of all labelled ones."""
    model = _ratios(docs, labels, id_col, text_col, label_col)
    scored = _scored(docs, model, id_col, text_col)
    model.threshold = _threshold(scored, model, labels, id_col, label_col)
    return model


def base_udf():
    def base(column: pa.Array) -> pa.Array:
        parts = [base_block(text, offsets) for _, text, offsets in wb.blocks(column)]
        names = [x.split()[0] for x in BASE.split(", ")]
        cols = [pa.array(np.concatenate([p[k] for p in parts]) if parts else [], pa.int64())
                for k in range(len(names))]
        return pa.StructArray.from_arrays(cols, names)

    return F.arrow_udf(base, f"struct<{BASE.replace(' ', ':').replace(',:', ',')}>")


def failed(base: Column) -> Column:
    """Whether a text with these base statistics fails the base rules."""
    n = base["n_words"]
    return (n < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * n)


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per document: its base statistics, base_failed, kept, mean_log_ratio."""
    model = _ratios(docs, labels, id_col, text_col, "quality")
    scored = written(_scored(docs, model, id_col, text_col), "scored")
    model.threshold = _threshold(scored, model, labels, id_col, "quality")
    return scored.select(
        "doc_id", "b.*", failed(F.col("b")).alias("base_failed"),
        (~failed(F.col("b")) & (F.col("mean_log_ratio") >= model.threshold)).alias("kept"),
        "mean_log_ratio")


def kept_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    model = fit(docs, labels, id_col, text_col)
    base, score = base_udf(), model.score(docs.sparkSession)
    return docs.where(~failed(base(F.col(text_col)))
                      & (score(F.col(text_col)) >= model.threshold))
