"""Licence scan: positional rare-token index over licence templates.

Document frequencies of the templates' words, counted over every whole text of
the corpus, give their IDF. A template is one or more parts, the stretches between
what its users fill in. Each part is indexed by its highest-IDF words
(``RARE_SHARE`` of its distinct words): word -> (part, position). A file's
occurrences of indexed words vote for (part, file position - part position); an
alignment whose agreeing words hold ``MIN_MASS`` of the part's indexed IDF mass
(positions may slip by ``SLIP`` words) counts when the part's mandatory key
phrases stand in the aligned stretch. A template's score is the greatest IDF mass
of its parts aligned one behind the other, over the mass of all; it is found at
``MIN_TEMPLATE`` (a cut notice still is) if every part with a key phrase is. A
template that holds another's text whole stands for it (``licence_texts.EXTENDS``).
No occurrence is capped or skipped; only the templates whose key phrases all stand
somewhere in a file are voted for, as the others can't be found.

Beside it, the base rule lists every place of three phrases. Words are runs of
ASCII letters and digits (A-Z lower-cased) and non-ASCII characters.

Defined cases: a null or empty text has no words, no labels and score 0;
repeated documents get equal rows; an empty table gives no rows; only the id
and text columns are read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordbytes as wb
from .licence_texts import EXTENDS, TEMPLATES

RARE_SHARE, MIN_MASS, SLIP, MIN_TEMPLATE = 0.6, 0.7, 2, 0.5

# Phrases of the base rule and their labels.
BASE_PHRASES = (("mit license", "mit"), ("apache license", "apache"),
                ("general public license", "gpl"))

_KINDS = np.zeros(256, np.uint8)
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _KINDS[_a:_b] = 1


def _words(text: np.ndarray, offsets: np.ndarray) -> wb.Words:
    return wb.words(text, offsets, _KINDS, wb.LOWER)


def _hashed(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return _words(raw, np.array([0, len(raw)])).hash


def _places(w: wb.Words, phrase: np.ndarray) -> np.ndarray:
    """Index of every word at which the phrase's words stand consecutively."""
    n = len(w.hash) - len(phrase) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(w.hash[:n] == phrase[0])
    for k in range(1, len(phrase)):
        at = at[w.hash[at + k] == phrase[k]]
    row = np.searchsorted(w.first, at, "right")
    return at[row == np.searchsorted(w.first, at + len(phrase) - 1, "right")]


def vocabulary(templates=TEMPLATES) -> np.ndarray:
    return np.unique(np.concatenate([_hashed(p) for _, parts, _ in templates for p in parts]))


@dataclass
class Index:
    """Indexed words (sorted hashes), their IDF and postings; per part its template,
    word count, indexed IDF mass and key phrases; per template its parts."""

    hashes: np.ndarray
    idf: np.ndarray
    postings: list[list[tuple[int, int]]]
    template: list[int]
    length: list[int]
    mass: list[float]
    keys: list[list[np.ndarray]]
    label: list[str]
    parts: list[list[int]]


def build_index(idf: dict[int, float], templates=TEMPLATES) -> Index:
    postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
    out = Index(np.zeros(0), np.zeros(0), [], [], [], [], [], [], [])
    for t, (label, parts, keys) in enumerate(templates):
        wanted = [_hashed(k) for k in keys]
        out.label.append(label)
        out.parts.append([])
        for part in parts:
            words = _hashed(part)
            seq, p = words.tolist(), len(out.template)
            ranked = sorted(set(seq), key=lambda h: (-idf[h], seq.index(h)))
            rare = set(ranked[:max(1, round(RARE_SHARE * len(ranked)))])
            for at, h in enumerate(seq):
                if h in rare:
                    postings[h].append((p, at))
            out.parts[t].append(p)
            out.template.append(t)
            out.length.append(len(seq))
            out.mass.append(sum(idf[h] for h in seq if h in rare))
            out.keys.append([k for k in wanted if _holds(words, k)])
            wanted = [k for k in wanted if not _holds(words, k)]
        if wanted:
            raise ValueError(f"{label}: a key phrase stands in none of the parts")
    out.hashes = np.array(sorted(postings), np.uint64)
    out.idf = np.array([idf[h] for h in out.hashes.tolist()])
    out.postings = [postings[h] for h in out.hashes.tolist()]
    return out


def _lookup(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, index into the sorted table) of the values that it holds."""
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    hit = np.flatnonzero(table[at] == values)
    return hit, at[hit]


def _aligned(votes: dict[int, float], mass: float) -> list[tuple[int, float]]:
    """Offsets whose votes, with those that slipped a little, reach the mass."""
    found = []
    for d in votes:
        total = sum(votes.get(d + s, 0.0) for s in range(-SLIP, SLIP + 1))
        if total >= MIN_MASS * mass:
            found.append((d, min(1.0, total / mass)))
    return found


def in_order(found: list[list[tuple[int, int, float]]]) -> float:
    """The greatest total weight of alignments (start, end, weight), at most one of
    each part, of parts that follow one another (a few words may overlap)."""
    ends: list[tuple[int, float]] = []         # ascending ends, greatest totals so far
    best = 0.0
    for alignments in found:
        new = []
        for start, end, weight in alignments:
            k = bisect_right(ends, (start + 2 * SLIP, float("inf")))
            new.append((end, weight + (ends[k - 1][1] if k else 0.0)))
        top, merged = 0.0, []
        for end, total in sorted([*ends, *new]):
            top = max(top, total)
            merged.append((end, top))
        ends, best = merged, max(best, top)
    return best


def _template_scores(places: list[int], words: list[int], part_of: np.ndarray, first: int,
                     wanted: set[int], index: Index) -> dict[int, float]:
    """Scores of the wanted templates in a file whose indexed words stand at
    ``places`` (from ``first``)."""
    votes: dict[int, dict[int, float]] = defaultdict(lambda: defaultdict(float))
    seen = set()
    for place, x in zip(places, words):
        for p, at in index.postings[x]:
            if index.template[p] in wanted and (p, place - at, at) not in seen:
                seen.add((p, place - at, at))
                votes[p][place - at] += float(index.idf[x])
    found: dict[int, list[tuple[int, int, float]]] = {}
    for p, by in votes.items():
        hits = []
        for d, share in _aligned(by, index.mass[p]):
            a = max(0, d - first - SLIP)
            b = max(0, d - first + index.length[p] + SLIP)
            if all(_holds(part_of[a:b], key) for key in index.keys[p]):
                hits.append((d, d + index.length[p], share * index.mass[p]))
        if hits:
            found[p] = sorted(hits)
    scores = {}
    for t in wanted:
        parts = index.parts[t]
        if all(p in found for p in parts if index.keys[p]):
            share = in_order([found.get(p, []) for p in parts]) / sum(index.mass[p] for p in parts)
            if share >= MIN_TEMPLATE:
                scores[t] = min(1.0, share)
    return scores


def _candidates(w: wb.Words, index: Index) -> list[set[int]]:
    """Per row, the templates whose key phrases all stand in it."""
    known: dict[bytes, np.ndarray] = {}
    out: list[set[int]] = [set() for _ in range(w.rows)]
    for t, parts in enumerate(index.parts):
        rows = None
        for key in (k for p in parts for k in index.keys[p]):
            name = key.tobytes()
            if name not in known:
                known[name] = np.unique(np.searchsorted(w.first, _places(w, key), "right") - 1)
            rows = known[name] if rows is None else np.intersect1d(rows, known[name])
        for row in range(w.rows) if rows is None else rows.tolist():
            out[row].add(t)
    return out


def scan_block(text: np.ndarray, offsets: np.ndarray, index: Index):
    """Rows (n_words, n_base, first, last, base labels, labels, score) of a block."""
    w = _words(text, offsets)
    base: list[list[tuple[int, str]]] = [[] for _ in range(w.rows)]
    for phrase, label in BASE_PHRASES:
        at = _places(w, _hashed(phrase))
        for row, place in zip(np.searchsorted(w.first, at, "right") - 1, at):
            base[row].append((int(place - w.first[row]), label))
    wanted = _candidates(w, index)
    for row in range(w.rows):
        lo, hi = int(w.first[row]), int(w.first[row + 1])
        more: set[str] = set()
        score = 0.0
        if wanted[row]:
            part = w.hash[lo:hi]
            hit, word = _lookup(part, index.hashes)
            scores = _template_scores((hit + lo).tolist(), word.tolist(), part, lo, wanted[row], index)
            more = {index.label[t] for t in scores}
            more -= {x for label in more for x in EXTENDS.get(label, ())}
            score = max((s for t, s in scores.items() if index.label[t] in more), default=0.0)
        starts = [s for s, _ in base[row]]
        own = sorted({label for _, label in base[row]})
        yield (hi - lo, len(starts), min(starts, default=None), max(starts, default=None),
               ",".join(own), ",".join(sorted(more.union(own))), score)


def _holds(part: np.ndarray, key: np.ndarray) -> bool:
    n = len(part) - len(key) + 1
    if n <= 0:
        return False
    same = np.ones(n, bool)
    for k in range(len(key)):
        same &= part[k:k + n] == key[k]
    return bool(same.any())


def corpus_idf(docs: DataFrame, text_col: str = "text", templates=TEMPLATES) -> dict[int, float]:
    """IDF of the templates' words over all documents (a row per word and task)."""
    words = vocabulary(templates)

    def count(batches):
        total, n = np.zeros(len(words), np.int64), 0
        for batch in batches:
            for _, text, offsets in wb.blocks(batch.column(0)):
                w = _words(text, offsets)
                hit, word = _lookup(w.hash, words)
                pair = np.unique((np.searchsorted(w.first, hit, "right") - 1) * len(words) + word)
                total += np.bincount(pair % len(words), minlength=len(words))
                n += w.rows
        yield pa.RecordBatch.from_pydict({
            "word": pa.array(np.arange(len(words) + 1), pa.int32()),
            "n": pa.array(np.append(total, n), pa.int64())})

    rows = (docs.select(text_col).mapInArrow(count, "word int, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).collect())
    df = {r.word: r.n for r in rows}
    everything = df.get(len(words), 0)
    return {h: float(np.log((everything + 2) / (df.get(k, 0) + 1)))
            for k, h in enumerate(words.tolist())}


RESULT = ("n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates=TEMPLATES) -> DataFrame:
    """One row per document: its base places, labels and best template score."""
    index = build_index(corpus_idf(docs, text_col, templates), templates)
    names = [c.split()[0] for c in RESULT.split(", ")]
    kinds = [{"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[c.split()[1]]
             for c in RESULT.split(", ")]

    def rows(column: pa.Array) -> pa.Array:
        found = [r for _, text, offsets in wb.blocks(column)
                 for r in scan_block(text, offsets, index)]
        cols = list(zip(*found)) if found else [[] for _ in names]
        return pa.StructArray.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, kinds)], names)

    kind = ",".join(c.replace(" ", ":") for c in RESULT.split(", "))
    found = F.arrow_udf(rows, f"struct<{kind}>")(F.col(text_col))
    return (docs.select(F.col(id_col).alias("doc_id"), found.alias("r"))
            .select("doc_id", "r.*"))
