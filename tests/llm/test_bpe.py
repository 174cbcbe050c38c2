from __future__ import annotations

import hashlib
import random
import struct

import public_tokenizers
import pytest
from corpus_cases import colliding, docs, odd_rows, prose
from tokenizers import Tokenizer

from eventide.llm import bpe, pretokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def texts():
    r = random.Random(5)
    alphabet = "ab1 \n\t'!é<|s 日\r🎉stvelrdm"
    out = ["".join(r.choice(alphabet) for _ in range(r.randrange(1, 50))) for _ in range(400)]
    return out + ["x<|endoftext|> y<|endoftext|><|endoftext|>", "<|endoftext|>", "'s's 'll",
                  "a  b  c", " lead", "trail  ", "\n\n\n", prose(3, 3000)]


def test_splits_and_words_equal_the_tokenizer(tokenizer):
    split, encode = pretokens.WordSplitter(PATH), pretokens.WordEncoder(PATH)
    some = texts()
    points, starts, first = split.split(some)
    for k, text in enumerate(some):
        ids = [i for j in range(first[k], first[k + 1])
               for i in encode(split.word(points, starts[j], starts[j + 1]))]
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_round_trip_equals_the_tokenizer(spark, tokenizer):
    rows = list(enumerate(texts())) + [(i, t) for i, t in odd_rows()]
    table = docs(spark, rows)
    got = sorted(((r.doc_id, list(r.ids), r.text) for r in
                  bpe.decode(bpe.encode(table, PATH), PATH).collect()), key=str)
    want = []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        want.append((i, ids, tokenizer.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=str)


def test_digests(spark, tokenizer):
    ids = tokenizer.encode("Two words, é.", add_special_tokens=False).ids
    r = bpe.digests(docs(spark, [(1, "Two words, é.")]), PATH).first()
    assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
        len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
        hashlib.sha256("Two words, é.".encode()).hexdigest())


def test_bytes_that_are_no_utf8_decode_to_the_replacement(spark, tokenizer):
    half = tokenizer.encode("🎉", add_special_tokens=False).ids[:1]
    df = spark.createDataFrame([(1, half), (2, [])], "doc_id long, ids array<int>")
    out = {r.doc_id: r.text for r in bpe.decode(df, PATH).collect()}
    assert out == {1: tokenizer.decode(half, skip_special_tokens=False), 2: ""}


def test_empty_table(spark):
    assert bpe.digests(docs(spark, [(1, "x")]).limit(0), PATH).count() == 0


def test_long_words_of_one_hash_stay_apart(spark, tokenizer):
    split = pretokens.WordSplitter(PATH)
    for n in (1024, 4096, 100_352):
        one, two = colliding(n)
        points, starts, _ = split.split([one, two, one])
        h = split.hashes(points, starts)
        assert h[0] == h[1]                       # the hash alone can't tell them
        index, words = split.distinct([one, two, one], points, starts)
        assert [words[k] for k in index] == [one, two, one]
    rows = [(k, t) for k, t in enumerate(t for n in (1024, 4096, 100_352) for t in colliding(n))]
    rows.append((9, "{} {} x {}".format(*colliding(2048), colliding(2048)[0])))
    out = bpe.decode(bpe.encode(docs(spark, rows), PATH), PATH).collect()
    assert {r.doc_id: (list(r.ids), r.text) for r in out} == {
        i: (tokenizer.encode(t, add_special_tokens=False).ids, t) for i, t in rows}


def test_few_word_buckets_and_short_memory(spark, tokenizer):
    block = bpe._Block(pretokens.WordSplitter(PATH))
    some = texts()[:60] + [prose(k, 300) for k in range(9)]
    block.add(list(range(len(some))), some)
    rows = block.rows(7, 3)
    assert {r[1] for r in rows} == {-1, 0, 1, 2} and len(rows) == 4
    said = [w for r in rows if r[1] >= 0 for w in _words_of(r)]
    assert sorted(said) == sorted(w.encode() for w in block.words) and len(set(said)) == len(said)


def _words_of(row):
    import pyarrow as pa
    raw, at = pa.decompress(row[4], sum(row[3]), codec="zstd", asbytes=True), 0
    for size in row[3]:
        yield raw[at:at + size]
        at += size
