from __future__ import annotations

import zlib

from corpus_cases import docs, odd_rows, prose

from eventide.llm import sharding


def test_contiguous_near_equal_gapless(spark):
    rows = [(k, prose(k, 5 + (k * 37) % 200)) for k in range(500)]
    out = sharding.balanced_shards(docs(spark, rows), 8).collect()
    assert len(out) == 500
    by_id = dict(rows)
    total = sum(r["size"] for r in out)
    last = -1
    for s in range(8):
        own = sorted((r for r in out if r["shard"] == s), key=lambda r: r["slot"])
        assert [r["slot"] for r in own] == list(range(len(own)))
        assert [r["doc_id"] for r in own] == sorted(r["doc_id"] for r in own)
        assert own[0]["doc_id"] > last
        last = own[-1]["doc_id"]
        assert abs(sum(r["size"] for r in own) - total / 8) <= max(r["size"] for r in out)
    for r in out:
        raw = by_id[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
        assert (r["law"], r["grown_shard"]) == ("bytes", None)


def test_odd_rows(spark):
    rows = odd_rows()
    out = sharding.balanced_shards(docs(spark, rows), 4).collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in out) == sorted(
        (str(i), len((t or "").encode()) + 16) for i, t in rows)
    assert {r["text_crc32"] for r in out if r["doc_id"] in (1, 2)} == {0}
    for s in {r["shard"] for r in out}:
        own = sorted(r["slot"] for r in out if r["shard"] == s)
        assert own == list(range(len(own)))


def test_one_text_holds_most_bytes_and_empty_table(spark):
    rows = [(k, "x" * (100000 if k == 3 else 10)) for k in range(6)]
    out = {r["doc_id"]: r["shard"] for r in sharding.balanced_shards(docs(spark, rows), 4).collect()}
    assert [out[k] for k in sorted(out)] == sorted(out.values())
    assert sharding.balanced_shards(docs(spark, rows).limit(0), 4).count() == 0


def test_every_row_is_where_the_prefix_sums_say(spark):
    rows = [(k * 7 % 300, prose(k, 3 + (k * 31) % 150)) for k in range(300)] + odd_rows() + odd_rows()
    plain = sorted(((i is not None, i or 0, zlib.crc32(t), len(t) + 16)
                    for i, t in ((i, (t or "").encode()) for i, t in rows)))
    total, upto, want, seen = sum(r[3] for r in plain), 0, [], {}
    for known, i, crc, size in plain:
        shard = min(6, (2 * upto + size) * 7 // (2 * total))
        upto += size
        slot = seen[shard] = seen.get(shard, -1) + 1
        want.append((i if known else None, size, crc, shard, slot))
    got = sharding.balanced_shards(docs(spark, rows), 7).select(
        "doc_id", "size", "text_crc32", "shard", "slot").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
