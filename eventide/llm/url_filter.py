"""URL rules answered by Bloom filter cascades: exact membership without joins.

A rule is a host, a path and a verdict; it fits its host and all subdomains
where the url's path starts with the rule's, and the longest fitting rule wins.
A url's candidate keys are therefore few: label-aligned suffixes of its host
joined with the prefixes of its path that have a rule path's length.

The complete key universe of the corpus is known (every candidate key of every
url), so a cascade of Bloom filters decides membership exactly: level 1 encodes
the listed keys, level 2 the universe's keys that pass level 1 without being
listed, level 3 the listed keys that pass level 2, and so on until nothing
passes wrongly. A key's answer is the parity of the first level that refuses
it. One cascade tells which candidate keys are rules, a second one which rules
block. Only the levels' bits travel to the rows.

The universe is distinct key hashes (two 64-bit hashes of the text), combined
before the one shuffle; bits are combined per task and then by word. A level's
bits are broadcast, which is checked: where the listed keys need more than
``FILTER_BYTES``, they are split by hash and the rows pass one part after the
other, each with its own cascade.

Defined cases: the host is what follows the first ``://`` up to ``/``, ``?``,
``#`` or the end, ``A-Z`` lower-cased, the path what follows up to ``?``, ``#``
or the end; a null url or one without ``://`` has empty host and path, fits a
rule only if the rule's host is empty, and keeps its row; a url that fits no
rule is not listed and gets ``otherwise``; of candidate keys of one length the
one with the longer host wins; a rule listed with both verdicts blocks; null
rule hosts or paths read as empty; repeated rows stay; an empty table or no
rules work; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .wordbytes import mix

FILTER_BYTES = 32 << 20      # bits of one cascade's first level, at most
MAX_LEVELS = 200             # halves each time; reached only if two keys share both hashes

_UPPER, _LOWER = (bytes(range(a, a + 26)).decode() for a in (65, 97))
_C1, _C2, _ONES = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, (1 << 64) - 1


# --- cascade -------------------------------------------------------------------

@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``hashes`` positions among ``size`` bits."""

    depth: int
    size: int
    hashes: int
    words: np.ndarray

    @classmethod
    def planned(cls, depth: int, keys: int, rate: float) -> Level:
        bits = math.log2(1 / rate)
        size = max(64, math.ceil(keys * bits / math.log(2)))
        return cls(depth, size, max(1, round(bits)), np.zeros(0, np.uint64))

    def positions(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """(keys, hashes) bit positions; every depth hashes anew."""
        one, two = (np.uint64((self.depth + 1) * c & _ONES) for c in (_C1, _C2))
        a, b = mix(h1 + one), mix(h2 ^ two) | np.uint64(1)
        steps = np.arange(self.hashes, dtype=np.uint64)
        return (a[:, None] + b[:, None] * steps) % np.uint64(self.size)

    def passes(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        at = self.positions(h1, h2)
        bit = self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))
        return (bit & np.uint64(1)).all(axis=1)


@dataclass
class Cascade:
    levels: list[Level] = field(default_factory=list)

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Whether each key (of the universe) is listed."""
        out = np.zeros(len(h1), bool)
        left = np.arange(len(h1))
        for n, level in enumerate(self.levels):
            if not len(left):
                break
            ok = level.passes(h1[left], h2[left])
            out[left[~ok]] = n % 2 == 1        # refused by an even level: listed
            left = left[ok]
        out[left] = len(self.levels) % 2 == 1
        return out

    @property
    def size_bytes(self) -> int:
        return sum(level.words.nbytes for level in self.levels)


def _longs(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


def _encoded(keys: DataFrame, level: Level) -> Level:
    """The level with the bits of all keys: combined per batch, then by word."""
    def bits(batches):
        for b in batches:
            at = np.unique(level.positions(_longs(b.column(0)), _longs(b.column(1))))
            if not len(at):
                continue
            word, first = np.unique(at >> np.uint64(6), return_index=True)
            mask = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
            yield pa.RecordBatch.from_pydict({"word": pa.array(word.astype(np.int64)),
                                              "mask": pa.array(mask.view(np.int64))})

    table = (keys.select("h1", "h2").mapInArrow(bits, "word long, mask long")
             .groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow())
    words = np.zeros(-(-level.size // 64), np.uint64)
    words[table["word"].to_numpy()] = table["mask"].to_numpy().view(np.uint64)
    return Level(level.depth, level.size, level.hashes, words)


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def run(batches):
        for b in batches:
            ok = shared.value.passes(_longs(b.column(0)), _longs(b.column(1)))
            yield b.filter(pa.array(ok))

    return keys.select("h1", "h2").mapInArrow(run, "h1 long, h2 long")


def first_rate(listed: int, universe: int) -> float:
    """False-positive rate of level 1 that makes the whole cascade smallest."""
    return min(0.5, math.sqrt(0.5) * max(listed, 1) / max(universe - listed, 1))


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """Cascade of the ``listed`` keys, exact on ``universe`` (distinct h1, h2)."""
    n = listed.count()
    rate = first_rate(n, universe.count())
    cascade, inside, outside = Cascade(), listed, universe
    while n:
        depth = len(cascade.levels)
        if depth == MAX_LEVELS:
            raise ValueError("two keys share both hashes: the cascade can't tell them apart")
        level = _encoded(inside, Level.planned(depth, n, rate))
        cascade.levels.append(level)
        wrong = _passing(outside, level)
        if depth == 0:       # later levels only see keys of the right kind
            wrong = wrong.join(listed, ["h1", "h2"], "left_anti")
        inside, outside = written(wrong, "cascade"), inside
        n, rate = inside.count(), 0.5
    return cascade


# --- urls ----------------------------------------------------------------------

def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def candidate_keys(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """Candidate keys, longest first: the last 1 to ``labels`` labels of the host,
    each with the path's prefixes of these lengths."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(n, F.lit(labels))),
        lambda k: F.array_join(F.slice(parts, n - k + 1, k), "."))
    prefixes = F.filter(F.array(*[F.when(F.length(path) >= k, F.substring(path, 1, k))
                                  for k in lengths]), lambda p: p.isNotNull())
    both = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.struct(
        (F.length(s) + F.length(p)).alias("size"), F.length(s).alias("own"),
        F.concat(s, p).alias("key")))))
    return F.transform(F.sort_array(both, asc=False), lambda x: x.getField("key"))


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.concat(F.lit("\x01"), key)).alias("h2")]


def _decide(rules: Cascade, blocks: Cascade, part: int, parts: int, spark):
    shared = spark.sparkContext.broadcast((rules, blocks))

    @F.arrow_udf("int")
    def decide(h1: pa.Array, h2: pa.Array) -> pa.Array:
        """Twice the index of the first listed key, plus one where it blocks."""
        mine, blocking = shared.value
        one, two = _longs(h1.flatten()), _longs(h2.flatten())
        ends = np.cumsum(h1.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        row = np.searchsorted(ends, np.arange(len(one)), "right")
        place = np.arange(len(one)) - np.concatenate([[0], ends])[row]
        at = np.flatnonzero((one >> np.uint64(1)) % np.uint64(parts) == part)
        at = at[mine.has(one[at], two[at])]
        rows, first = np.unique(row[at], return_index=True)
        at = at[first]
        out = np.full(len(h1), -1, np.int32)
        out[rows] = 2 * place[at] + blocking.has(one[at], two[at])
        return pa.array(out, mask=out < 0)

    return decide


def verdicts(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
             otherwise: str = "allow", filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(id, host, path, rule, verdict) of every row of ``pages``.

    ``rules`` holds host, path and verdict (``allow`` or ``block``); ``rule`` is the
    host and path of the rule that won, null where none fits.
    """
    spark = pages.sparkSession
    host = F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER)
    path = F.coalesce("path", F.lit(""))
    listed = written(rules.select(F.concat(host, path).alias("key"), F.lower("verdict").alias(
        "verdict"), F.size(F.split(host, r"\.")).alias("labels"), F.length(path).alias("length"))
        .withColumns(dict(zip(("h1", "h2"), _hashes(F.col("key"))))), "rules")
    # one number and the distinct lengths of rule paths
    labels = listed.agg(F.max("labels")).first()[0] or 1
    lengths = sorted(r[0] for r in listed.select("length").distinct().collect()) or [0]

    rows = (pages.select(F.col(id_col), F.col(url_col).alias("_url"))
            .select(id_col, *(c.alias(n) for c, n in zip(host_and_path(F.col("_url")),
                                                         ("host", "path")))))
    keyed = rows.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), labels, lengths))
    keyed = keyed.withColumns({"h1": F.transform("keys", lambda x: _hashes(x)[0]),
                               "h2": F.transform("keys", lambda x: _hashes(x)[1])})
    universe = written(keyed.select(F.inline(F.arrays_zip("h1", "h2"))).distinct(), "universe")

    own = listed.select("h1", "h2", "verdict").groupBy("h1", "h2").agg(
        F.bool_or(F.col("verdict") == "block").alias("block"))
    own = written(own, "listed")
    n = own.count()
    need = n * -math.log2(first_rate(n, universe.count())) / math.log(2) / 8
    parts = max(1, math.ceil(need / filter_bytes))
    found = keyed.withColumn("hit", F.lit(None).cast("int"))
    for part in range(parts):
        here = F.shiftrightunsigned("h1", 1) % parts == part
        mine = own.where(here)
        cascade = build_cascade(mine.select("h1", "h2"), universe.where(here))
        blocks = build_cascade(mine.where("block").select("h1", "h2"), mine.select("h1", "h2"))
        decide = _decide(cascade, blocks, part, parts, spark)
        found = found.withColumn("hit", F.least("hit", decide("h1", "h2")))
        if part < parts - 1:         # one part's bits at a time
            found = written(found, "passed")
    return found.select(
        id_col, "host", "path",
        F.when(F.col("hit").isNotNull(), F.get("keys", (F.col("hit") / 2).cast("int"))).alias("rule"),
        F.when(F.col("hit").isNull(), F.lit(otherwise))
        .when(F.col("hit") % 2 == 1, F.lit("block")).otherwise(F.lit("allow")).alias("verdict"))
