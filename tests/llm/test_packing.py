from __future__ import annotations

import itertools
import random
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
from corpus_cases import colliding, docs, odd_rows, prose
from tokenizers import Tokenizer

from eventide.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_closest_fill_is_the_best_subset_sum():
    r = random.Random(1)
    for _ in range(200):
        counts = {r.randrange(1, 30): r.randrange(1, 4) for _ in range(r.randrange(1, 6))}
        room = r.randrange(1, 70)
        items = [x for x, n in counts.items() for _ in range(n)]
        best = max(s for k in range(len(items) + 1) for c in itertools.combinations(items, k)
                   if (s := sum(c)) <= room)
        chosen = packing.closest_fill(counts, room)
        assert sum(x * n for x, n in chosen.items()) == best
        assert all(n <= counts[x] for x, n in chosen.items())


def test_plan_uses_every_piece_once_with_little_padding():
    r = random.Random(2)
    counts = Counter(min(2047, max(1, int(r.lognormvariate(6, 1)))) for _ in range(5000))
    plan = packing.fill_plan(counts, 2048)
    used = Counter()
    for chosen, times in plan:
        assert sum(x * n for x, n in chosen.items()) <= 2048
        for x, n in chosen.items():
            used[x] += n * times
    assert used == counts
    total = sum(x * n for x, n in counts.items())
    assert sum(t for _, t in plan) * 2048 - total < 0.005 * total


def test_pieces_are_whole_and_sequences_gapless(spark):
    tokenizer = Tokenizer.from_file(PATH)
    rows = [(100 + k, prose(k, 20 + 37 * k)) for k in range(60)] + [(500, prose(9, 9000))] + odd_rows()
    out = packing.pack(docs(spark, rows), PATH).collect()
    encoded = defaultdict(list)
    for i, t in rows:
        encoded[i].append(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])
    pieces = defaultdict(list)
    for r in out:
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(encoded)
    for i, own in pieces.items():
        ids, copies = encoded[i][0], len(encoded[i])
        want = Counter((a, len(ids[a:a + 2048]), len(ids), zlib.crc32(
            struct.pack(f"<{len(ids[a:a + 2048])}I", *ids[a:a + 2048])))
            for a in range(0, len(ids), 2048) for _ in range(copies))
        assert Counter((r.start, r.length, r.doc_tokens, r.ids_crc32) for r in own) == want
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048


def test_empty_table(spark):
    assert packing.pack(docs(spark, [(1, "x")]).limit(0), PATH).count() == 0


def test_long_words_of_one_hash_stay_apart(spark):
    tokenizer = Tokenizer.from_file(PATH)
    rows = list(enumerate(t for n in (1024, 4096, 100_352) for t in colliding(n)))
    want = set()
    for i, t in rows:
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [1]
        want |= {(i, a, zlib.crc32(struct.pack(f"<{len(ids[a:a + 2048])}I", *ids[a:a + 2048])))
                 for a in range(0, len(ids), 2048)}
    out = packing.pack(docs(spark, rows).coalesce(1), PATH).collect()
    assert {(r.doc_id, r.start, r.ids_crc32) for r in out} == want
