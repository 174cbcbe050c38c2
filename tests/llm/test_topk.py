from __future__ import annotations

import math

import numpy as np
from conftest import SF_SMALL

from eventide.llm import topk
from eventide.llm.common import table


def brute(rows, k, every, scale=256):
    ok = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
          if i is not None and v is not None
          and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in dict(reversed([r for r in ok if r[0] % every == 0])).items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def got(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows],
                                 "vec_id long, embedding array<float>, label int, block int, "
                                 "n int, slice int")


def test_matches_brute_force_with_ties_and_bad_vectors(spark):
    r = np.random.default_rng(3)
    rows = [(k, [float(np.float32(x)) for x in r.normal(size=24) * 0.3]) for k in range(300)]
    rows[10] = (10, rows[50][1])
    rows[11] = (11, rows[50][1])
    rows += [(301, None), (302, [float("nan")] * 24), (303, [None] * 24), (304, [float("inf")] * 24),
             (305, []), (None, rows[0][1]), (306, rows[0][1][:5]), (7, rows[7][1]), (50, rows[50][1])]
    assert got(topk.exact_topk(frame(spark, rows), 5, 50)) == brute(rows, 5, 50)


def test_clustered_vectors_prune_and_stay_exact(spark):
    r = np.random.default_rng(4)
    base = r.normal(size=(6, 64))
    rows = [(k, [float(np.float32(x)) for x in base[k % 6] + 0.05 * r.normal(size=64)])
            for k in range(400)]
    assert got(topk.exact_topk(frame(spark, rows), 5, 20)) == brute(rows, 5, 20)


def test_bounds_hold():
    r = np.random.default_rng(5)
    q, x = r.integers(-300, 300, (20, 64)).astype(float), r.integers(-300, 300, (50, 64)).astype(float)
    exact = q @ x.T
    coarse, fine = (topk.segment_stats(q, s) @ topk.segment_stats(x, s).T for s in topk.RESOLUTIONS)
    assert (coarse >= exact - 1e-6).all() and (fine >= exact - 1e-6).all()
    assert fine.mean() < coarse.mean()


def test_large_values_and_few_rows(spark):
    rows = [(0, [1e6, -1e6]), (1, [1e6, 1e6]), (2, [-1e6, 3e5])]
    assert got(topk.exact_topk(frame(spark, rows), 5, 50)) == brute(rows, 5, 50)
    assert topk.exact_topk(frame(spark, rows).limit(0), 5, 50).count() == 0


def test_given_table(spark):
    e = table(spark, SF_SMALL, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in e.collect()]
    assert got(topk.exact_topk(e)) == brute(rows, 5, 50)


def test_all_vectors_of_a_query_id_ask(spark):
    r = np.random.default_rng(8)
    rows = [(k, [float(np.float32(x)) for x in r.normal(size=24)]) for k in range(1, 300)]
    mine = [[float(np.float32(x)) for x in r.normal(size=24)] for _ in range(3)]
    rows += [(0, v) for v in mine] + [(0, mine[1])] + rows[7:9] * 6
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    asks = [v for i, v in whole if i == 0]
    best = sorted((-max(sum(a * b for a, b in zip(q, v)) for q in asks), i)
                  for i, v in whole if i)
    want = [(0, n + 1, i, -s) for n, (s, i) in enumerate(best[:9])]
    assert got(topk.exact_topk(frame(spark, rows), 9, 1000)) == want
    assert got(topk.exact_topk(frame(spark, rows[::-1]), 9, 1000)) == want


def test_many_query_blocks_and_no_broadcast(spark):
    r = np.random.default_rng(9)
    rows = [(k, [float(np.float32(x)) for x in r.normal(size=20)]) for k in range(400)]
    out = topk.exact_topk(frame(spark, rows), 4, 2, query_block=16)
    assert got(out) == brute(rows, 4, 2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Join" not in plan
