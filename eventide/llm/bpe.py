"""Byte-level BPE encoding and decoding over a distinct-word table.

1. Tasks split whole texts into the tokenizer's words, in blocks of about
   ``BLOCK_CHARS`` characters. A block keeps its distinct words and, per text
   position, the number of the word.
2. The blocks' distinct words meet in buckets of the word's checksum. A bucket
   holds every occurrence of its words, so each distinct word of the corpus is
   encoded once (again only where a bucket has over ``KNOWN_WORDS``); the ids travel back to the blocks that asked.
3. A block's ids are joined to its positions: each document's id sequence.
4. Decoding joins ids to their pieces (a table of the vocabulary's size,
   broadcast) and concatenates the bytes; byte sequences that are not UTF-8
   decode to U+FFFD, as the tokenizer does.

Only distinct words and ids are shuffled; positions are written once, bucketed
by block, and read in place. A hot word costs one entry per block. Blocks
bound a task's memory, whatever a partition or a bucket holds.

Defined cases: a null or empty text has no ids and decodes to the empty text;
added tokens inside a text become their single id, as in the tokenizer;
repeated rows and ids each keep their own row; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucketed, buckets_for
from .pretokens import WordEncoder, WordSplitter, spread, text_blocks
from .wordbytes import give_back

BLOCK_CHARS = 8 << 20
BUCKET_BYTES = 16 << 20      # input bytes per word bucket and per group of blocks
WORD_BUCKETS = 4096          # at most: a block has a row per bucket, not per word
KNOWN_WORDS = 1_000_000      # words of a bucket whose ids a task remembers

_PACKED = "block long, bucket int, docs array<long>, sizes array<int>, data binary"


@functools.lru_cache(2)
def splitter(path: str) -> WordSplitter:
    return WordSplitter(path)


@functools.lru_cache(2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _planes(values: np.ndarray, width: int) -> bytes:
    """Small unsigned integers by byte position, compressed."""
    raw = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T)
    return np.uint32(len(values)).tobytes() + bytes([width]) + pa.compress(
        raw.tobytes(), codec="zstd", asbytes=True)


def _unplanes(data: bytes) -> np.ndarray:
    n, width = int(np.frombuffer(data[:4], np.uint32)[0]), data[4]
    raw = np.frombuffer(pa.decompress(data[5:], n * width, codec="zstd", asbytes=True), np.uint8)
    out = np.zeros((n, 4), np.uint8)
    out[:, :width] = raw.reshape(width, n).T
    return out.reshape(-1).view("<u4").astype(np.int64)


def _width(high: int) -> int:
    return max(1, (int(high).bit_length() + 7) // 8)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(cols, kinds)],
        names=["block", "bucket", "docs", "sizes", "data"])


class _Block:
    """Distinct words and positions of texts added so far."""

    def __init__(self, split: WordSplitter):
        self.split, self.docs, self.chars = split, [], 0
        self.sizes: list[np.ndarray] = []
        self.places: list[np.ndarray] = []      # word number by position
        self.words: dict[str, int] = {}

    def add(self, ids: list, texts: list[str]) -> None:
        for _, part in text_blocks(texts):
            points, starts, at = self.split.split(part)
            index, words = self.split.distinct(part, points, starts)
            known = self.words
            own = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
            self.places.append(own[index])
            self.sizes.append(np.diff(at))
        self.docs += ids
        self.chars += sum(map(len, texts))

    def rows(self, block: int, buckets: int) -> list[tuple]:
        flat = np.concatenate(self.places) if self.places else np.zeros(0, np.int64)
        count = np.bincount(flat, minlength=len(self.words))
        # words are numbered by falling count, so that positions compress
        number = np.empty(len(count), np.int64)
        number[np.argsort(-count, kind="stable")] = np.arange(len(count))
        blobs = [w.encode() for w in self.words]
        bucket = np.array([zlib.crc32(w) % buckets for w in blobs], np.int64)
        order = sorted(range(len(blobs)), key=lambda k: (bucket[k], blobs[k]))
        out = []
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
        for b in range(buckets):
            if cuts[b] < cuts[b + 1]:
                part = [blobs[k] for k in order[cuts[b]:cuts[b + 1]]]
                out.append((block, b, None, [len(w) for w in part],
                            pa.compress(b"".join(part), codec="zstd", asbytes=True)))
        width = _width(len(count))
        sizes = np.concatenate(self.sizes) if self.sizes else np.zeros(0, np.int64)
        out.append((block, -1, self.docs, sizes.tolist(), b"".join(
            np.uint32(len(x)).tobytes() + x for x in (
                _planes(number[flat], width),             # word number by position
                _planes(number[order], width)))))         # word number by (bucket, word)
        return out


def _split(path: str, buckets: int):
    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        held = _Block(splitter(path))
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            row = 0
            for first, some in text_blocks(texts, BLOCK_CHARS):
                held.add(ids[first:first + len(some)], some)
                row = first + len(some)
                if held.chars >= BLOCK_CHARS:
                    yield _rows(held.rows((part << 32) + seq, buckets))
                    seq, held = seq + 1, _Block(held.split)
        if held.docs:
            yield _rows(held.rows((part << 32) + seq, buckets))
        del held
        give_back()
    return run


def _encode(path: str):
    """Words of a bucket to ids; rows come sorted by bucket."""
    def run(batches):
        encode = encoder(path)
        known: dict[bytes, list[int]] = {}
        now = None
        for batch in batches:
            rows = []
            for block, bucket, sizes, data in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != now:
                    known, now = {}, bucket
                raw = pa.decompress(data, sum(sizes), codec="zstd", asbytes=True)
                ids, counts, at = [], [], 0
                for size in sizes:
                    word = raw[at:at + size]
                    at += size
                    if word not in known:
                        if len(known) == KNOWN_WORDS:      # memory first: some are encoded again
                            known.clear()
                        known[word] = encode(word.decode())
                    ids += known[word]
                    counts.append(len(known[word]))
                flat = np.array(ids, np.int64)
                rows.append((block, bucket, _planes(np.array(counts), _width(max(counts))),
                             _planes(flat, _width(flat.max(initial=0)))))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), (
                        pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                    names=["block", "bucket", "counts", "ids"])
    return run


def _assemble(positions: pa.Table, found: pa.Table) -> pa.Table:
    """Id sequences of a block's documents."""
    docs, sizes, data = (positions.column(c)[0].as_py() for c in ("docs", "sizes", "data"))
    n = int(np.frombuffer(data[:4], np.uint32)[0])
    number, named = _unplanes(data[4:4 + n]), _unplanes(data[8 + n:])
    parts = sorted(zip(*(found.column(c).to_pylist() for c in ("bucket", "counts", "ids"))))
    if parts:
        count = np.concatenate([_unplanes(c) for _, c, _ in parts])
        flat = np.concatenate([_unplanes(i) for _, _, i in parts])
        at = np.concatenate([[0], np.cumsum(count)])
        where = np.empty(len(named), np.int64)
        where[named] = np.arange(len(named))
        ids, ends = spread(flat, at, where[number])
    else:
        ids, ends = np.zeros(0, np.int64), np.zeros(1, np.int64)
    cut = ends[np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))])]
    return pa.Table.from_arrays(
        [pa.array(docs, pa.int64()),
         pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(ids, pa.int32()))],
        names=["doc_id", "ids"])


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every document; ``path`` names the tokenizer file."""
    n = buckets_for(docs, BUCKET_BYTES)
    most = min(n, WORD_BUCKETS)
    packed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
                         ).mapInArrow(_split(path, most), _PACKED)
    # positions stay where they are written: the files are bucketed by block
    stored = bucketed(packed, "block", n, "bpe")

    words = stored.where(F.col("bucket") >= 0).select("block", "bucket", "sizes", "data")
    found = (words.repartition(most, "bucket").sortWithinPartitions("bucket")
             .mapInArrow(_encode(path), "block long, bucket int, counts binary, ids binary"))
    positions = stored.where(F.col("bucket") < 0).select("block", "docs", "sizes", "data")
    return (positions.groupBy("block").cogroup(found.repartition(n, "block").groupBy("block"))
            .applyInArrow(_assemble, "doc_id long, ids array<int>"))


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """The rows with a ``text`` column: ids joined to their pieces."""
    pieces = encoder(path).pieces
    size = max(pieces) + 1
    table = [pieces.get(i, b"") for i in range(size)]
    held = encoded.sparkSession.sparkContext.broadcast((
        np.frombuffer(b"".join(table), np.uint8),
        np.concatenate([[0], np.cumsum([len(p) for p in table])])))

    def texts(column: pa.Array) -> pa.Array:
        flat, at = held.value
        ends = column.offsets.to_numpy()
        ids = column.values.to_numpy()
        out = []
        for a, b in zip(ends[:-1], ends[1:]):
            raw, _ = spread(flat, at, ids[a:b])
            out.append(raw.tobytes().decode("utf-8", "replace"))
        return pa.array(out, pa.string())

    return encoded.withColumn("text", F.arrow_udf(texts, "string")(F.col(ids_col)))


def ids_sha256(column: pa.Array) -> pa.Array:
    """Lowercase hex SHA-256 of ids as little-endian unsigned 32-bit integers."""
    ends, ids = column.offsets.to_numpy(), column.values.to_numpy().astype("<u4")
    return pa.array([hashlib.sha256(ids[a:b].tobytes()).hexdigest()
                     for a, b in zip(ends[:-1], ends[1:])], pa.string())


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    both = decode(encode(docs, path), path)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.arrow_udf(ids_sha256, "string")("ids").alias("ids_sha256"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
