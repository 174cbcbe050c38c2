from __future__ import annotations

import math

import duckdb
import numpy as np
from conftest import SF_SMALL

from eventide.llm import hard_negatives as hn
from eventide.llm import queries


def brute(rows, every=100, positives=5, negatives=10):
    ok = [(i, y, [math.floor(256 * float(x)) for x in v]) for i, v, y in rows
          if i is not None and y is not None and v is not None
          and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, y, v in {(i, y, tuple(v)) for i, y, v in ok if i % every == 0}:
        score = sorted((-sum(p * q for p, q in zip(v, w)), i, z) for i, z, w in ok if i != a)
        for s, p, _ in [x for x in score if x[2] == y][:positives]:
            hard = [(-t, n) for t, n, z in score if z != y and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(a, p, k + 1, n, -s, t) for k, (t, n) in enumerate(hard[:negatives])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, v, y, 1, 2, 3, 4, 5) for i, v, y in rows],
        "vec_id long, embedding array<float>, label int, block int, n int, slice int, "
        "number int, anchor int")


def got(df):
    return sorted(map(tuple, df.collect()))


def vectors(seed, n, dim=24):
    r = np.random.default_rng(seed)
    base = r.normal(size=dim)
    return [[float(np.float32(x)) for x in base * 0.3 + r.normal(size=dim) * 0.4] for _ in range(n)]


def test_product_is_exact():
    r = np.random.default_rng(1)
    for m, k, n in ((1, 1, 1), (40, 17, 33), (129, 64, 200), (300, 70, 513), (64, 0, 64), (0, 5, 9)):
        a, b = r.integers(-1000, 1000, (m, k)), r.integers(-1000, 1000, (k, n))
        assert (hn.product(a, b, leaf=4) == a @ b).all()
    big = r.integers(-(1 << 29), 1 << 29, (70, 64)), r.integers(-(1 << 27), 1 << 27, (64, 70))
    assert (hn.product(*big, leaf=8) == big[0] @ big[1]).all()       # no double holds these sums


def test_heaps_merge_like_one_sort():
    r = np.random.default_rng(2)
    slot, score, vec = r.integers(0, 7, 3000), r.integers(-9, 9, 3000), r.integers(0, 500, 3000)
    whole, parts = hn.Heaps(7, 4), hn.Heaps(7, 4)
    whole.offer(slot, score, vec)
    for k in range(0, 3000, 251):
        parts.offer(slot[k:k + 251], score[k:k + 251], vec[k:k + 251])
    want = [sorted(zip(-score[slot == s], vec[slot == s]))[:4] for s in range(7)]
    for h in (whole, parts):
        assert [sorted(zip(-h.score[h.slot == s], h.id[h.slot == s])) for s in range(7)] == want


def test_best_cells_leave_the_best():
    r = np.random.default_rng(3)
    score = r.integers(-5, 5, (20, 90)) * np.where(np.arange(20) < 10, 1, 1 << 57)[:, None]
    allowed = r.random((20, 90)) < 0.7
    ids = np.sort(r.integers(0, 1000, 90))
    none = np.full(20, hn.LEAST), np.full(20, 1 << 62)
    for part in (slice(0, 10), slice(0, 20)):        # small scores; too large to rank ties
        at, col = hn.best_cells(score[part], ids, allowed[part].copy(), none[0][part], none[1][part], 6)
        for row in range(score[part].shape[0]):
            cells = sorted((-score[row, c], ids[c]) for c in np.flatnonzero(allowed[row]))[:6]
            mine = sorted((-score[row, c], ids[c]) for c in col[at == row])
            assert mine[:6] == cells


def test_matches_brute_force_with_ties_and_bad_rows(spark):
    v = vectors(4, 500)
    rows = [(k, v[k], k % 4) for k in range(500)]
    rows[11] = (11, v[60], 1)
    rows[12] = (12, v[60], 2)
    rows += [(600, None, 1), (700, v[0], None), (None, v[0], 1), (800, [float("nan")] * 24, 1),
             (900, [None] * 24, 1), (1000, [float("inf")] * 24, 1), (1100, [], 1),
             (1200, v[3][:5], 2), (1300, v[5], 9), (100, v[100], 0), (7, v[7], 3), (7, v[7], 3)]
    assert got(hn.mine(frame(spark, rows), every=50)) == brute(rows, 50)
    assert got(hn.mine(frame(spark, rows), every=50, positives=2, negatives=3)) == brute(rows, 50, 2, 3)


def test_small_blocks_and_equal_rows(spark):
    v = vectors(5, 300, 40)
    rows = [(k, v[k] if k % 3 else v[0], k % 3) for k in range(300)]     # a third are one vector
    small = dict(anchor_block=8, row_block=37, tile=3)
    assert got(hn.mine(frame(spark, rows), every=10, **small)) == brute(rows, 10)


def test_odd_tables(spark):
    assert got(hn.mine(frame(spark, []))) == []
    assert got(hn.mine(frame(spark, [(0, [1.0], 1)]))) == []
    assert got(hn.mine(frame(spark, [(0, [], 1), (1, [], 1), (2, [], 2)]))) == [(0, 1, 1, 2, 0, 0)]
    minus = [(0, [1.0], 1), (1, [-1.0], 1), (2, [-0.5], 2)]              # an empty window
    assert got(hn.mine(frame(spark, minus))) == brute(minus) == []
    two = [(0, [1.0, 0.5], 1), (0, [0.5, 1.0], 1), *((k, [0.1 * k, 0.3], k % 2) for k in range(1, 9))]
    assert got(hn.mine(frame(spark, two))) == brute(two)


def test_given_table_matches_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    want = sorted(con.sql(queries.SQL["op12_hard_negatives"]).fetchall())
    assert want and got(queries.op12_hard_negatives(spark, SF_SMALL)) == want
