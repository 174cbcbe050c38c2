"""Packing token sequences by minimum bin slack.

Documents are encoded whole, closed by an end id, and cut every ``window``
tokens; a full piece is a sequence of its own. The rests are packed by their
lengths alone: one histogram (at most ``window - 1`` counts, whatever the
corpus holds) describes them. The plan takes the longest remaining length and
lets a bitset subset-sum search find the multiset of remaining lengths that
fills the window closest to capacity, backtracking the counts, and repeats that
multiset as often as the histogram allows, so each step uses up a length and
the plan has a few thousand entries at any size.

Pieces find their places without being gathered: a piece's rank among the
pieces of its length is its rank inside its task plus the totals of the tasks
before it, and the plan maps ranges of ranks to sequences and offsets.

Sequences are numbered without gaps: full pieces first. A sequence is padded to
the window unless its fill is a power of two.

Defined cases: a null or empty text is the end id alone; repeated rows and ids
each get their own pieces; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import functools
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import encoder, splitter
from .common import written
from .pretokens import spread, text_blocks
from .wordbytes import give_back

WINDOW = 2048
END_ID = 1
KNOWN_WORDS = 100_000        # words whose ids a worker remembers, if they are
KNOWN_CHARS = 64             # no longer than this

_PIECES = ("doc_id long, start long, length int, ids_crc32 long, doc_tokens long, "
           "part int, place long")


class _Ids:
    """Ids of texts, word by word, remembering recent words."""

    def __init__(self, path: str):
        self.split, self.encode = splitter(path), encoder(path)
        self.known: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, running ends)."""
        points, starts, at = self.split.split(texts)
        index, words = self.split.distinct(texts, points, starts)
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        known, found = self.known, []
        for word in words:
            ids = known.get(word)
            if ids is None:
                ids = array("I", self.encode(word)).tobytes()
                if len(word) <= KNOWN_CHARS:
                    known[word] = ids
            found.append(ids)
        flat = np.frombuffer(b"".join(found), np.uint32)
        ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in found])]).astype(np.int64)
        ids, upto = spread(flat, ends, index)
        return ids, upto[at]


@functools.lru_cache(2)
def _ids(path: str) -> _Ids:
    return _Ids(path)


def _cut(path: str, window: int, end_id: int):
    def run(batches):
        part = TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)      # pieces of each length so far
        encode = _ids(path)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            docs = batch.column(0).to_pylist()
            rows = []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for first, some in text_blocks(texts):
                ids, ends = encode(some)
                for k in range(len(some)):
                    own = np.concatenate([ids[ends[k]:ends[k + 1]], end])
                    for a in range(0, len(own), window):
                        piece = own[a:a + window]
                        rows.append((docs[first + k], a, len(piece),
                                     zlib.crc32(piece.astype("<u4").tobytes()), len(own),
                                     part, int(seen[len(piece)])))
                        seen[len(piece)] += 1
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(),
                         pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                    names=[c.split()[0] for c in _PIECES.split(", ")])
        encode.known.clear()
        give_back()
    return run


# ---- the plan ------------------------------------------------------------------

def closest_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of available lengths with the largest sum up to ``room``."""
    reach, mask, taken = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x in counts if counts[x] > 0 and x <= room), reverse=True):
        left, chunk = min(counts[length], room // length), 1
        while left > 0:
            chunk = min(chunk, left)
            taken.append((length, chunk, reach))
            reach |= (reach << (length * chunk)) & mask
            left -= chunk
            chunk *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, chunk, before in reversed(taken):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + chunk
            total -= length * chunk
    return chosen


def fill_plan(counts: dict[int, int], window: int) -> list[tuple[dict[int, int], int]]:
    """(multiset of lengths, number of windows filled so) until nothing is left."""
    left = {x: n for x, n in counts.items() if n > 0}
    plan = []
    while left:
        longest = max(left)
        left[longest] -= 1
        chosen = closest_fill(left, window - longest)
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[x] // n for x, n in chosen.items())
        for x, n in chosen.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
        plan.append((chosen, times))
    return plan


def _places(plan: list[tuple[dict[int, int], int]], first: int) -> list[tuple]:
    """(length, rank from, rank to, copies per window, first sequence, offset)."""
    used: dict[int, int] = {}
    rows = []
    for chosen, times in plan:
        offset = 0
        for length in sorted(chosen, reverse=True):
            n, at = chosen[length], used.get(length, 0)
            rows.append((length, at, at + n * times, n, first, offset))
            used[length] = at + n * times
            offset += n * length
        first += times
    return rows


def pack(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    # the written copy fixes each piece's task and place, also for retries
    pieces = written(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .mapInArrow(_cut(path, window, end_id), _PIECES), "pieces")

    totals = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    base = totals.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0))
                         .alias("before"))
    counts = {r.length: r.n for r in
              totals.groupBy("length").agg(F.sum("n").alias("n")).collect()}   # <= window rows
    full = counts.pop(window, 0)
    places = _places([({window: 1}, full)] * bool(full) + fill_plan(counts, window), 0)
    where = spark.createDataFrame(
        places, "length int, low long, high long, copies int, first long, at int")

    ranked = (pieces.join(base, ["length", "part"])
              .withColumn("rank", F.col("before") + F.col("place")))
    k = F.col("rank") - F.col("low")
    return (ranked.alias("p").join(F.broadcast(where).alias("w"), (
                (F.col("p.length") == F.col("w.length")) & (F.col("rank") >= F.col("low"))
                & (F.col("rank") < F.col("high"))))
            .select("doc_id", "start", F.col("p.length").cast("long").alias("length"),
                    "ids_crc32", "doc_tokens",
                    (F.col("first") + F.floor(k / F.col("copies"))).cast("long")
                    .alias("sequence_id"),
                    (F.col("at") + (k % F.col("copies")) * F.col("p.length")).cast("long")
                    .alias("offset")))
