from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from corpus_cases import docs, odd_rows, prose

from eventide.llm import toxicity as tox
from eventide.llm import wordbytes as wb
from eventide.llm.common import table


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def planted(n=300):
    rows, lab = [], []
    for k in range(n):
        toxic = k % 5 == 0
        words = prose(k, 60).split()
        if toxic:
            for s in range(4):
                words[7 + 11 * s] = ("vile", "rotten", "nasty")[(k + s) % 3]
        rows.append((k, " ".join(words)))
        lab.append((k, 1, int(toxic)))
    return rows, lab


def test_features_are_words_pairs_and_skips():
    for _, text, offsets in wb.blocks(pa.array(["A b, c", "", None, "b"])):
        row, slot = tox._features(text, offsets, 20)
    assert np.bincount(row, minlength=4).tolist() == [6, 0, 0, 1]
    assert slot[1] == slot[3]                         # "b" in either text


def test_held_out_accuracy_and_repeatable(spark):
    rows, lab = planted()
    out = tox.toxicity_scores(docs(spark, rows), labels(spark, lab)).collect()
    truth = {i: t for i, _, t in lab}
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(r.predicted == truth[r.doc_id] for r in held)
    again = tox.toxicity_scores(docs(spark, rows), labels(spark, lab)).collect()
    assert sorted(out) == sorted(again)


def test_held_out_labels_are_not_learnt(spark):
    rows, lab = planted()
    other = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in lab]
    a, b = (sorted((r.doc_id, r.score) for r in
                   tox.toxicity_scores(docs(spark, rows), labels(spark, x)).collect())
            for x in (lab, other))
    assert a == b


def test_odd_rows(spark):
    rows, lab = planted(100)
    table_ = docs(spark, rows + [(i and i + 1000, t) for i, t in odd_rows()])
    doubled = labels(spark, lab + lab + [(None, 1, 1), (5000, 1, None), (6000, 1, 1)])
    out = tox.toxicity_scores(table_, doubled).collect()
    assert len(out) == 100 + len(odd_rows())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    empties = {r.score for r in out if r.doc_id in (1001, 1002, 1003)}
    assert len(empties) == 1 and empties.pop() < 0.5
    assert [r.held_out for r in out if r.doc_id is None] == [False]
    kept = tox.without_toxic(table_, doubled)
    assert kept.columns == table_.columns
    assert kept.count() == sum(r.predicted == 0 for r in out)


def test_without_labels_and_empty(spark):
    d, none = docs(spark, [(1, "x y")]), labels(spark, [])
    assert [r.score for r in tox.toxicity_scores(d, none).collect()] == [0.0]
    assert tox.toxicity_scores(d.limit(0), none).count() == 0


def test_given_table_recall_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    lab = table(spark, sf, "labels")
    out = (tox.toxicity_scores(table(spark, sf, "documents"), lab).where("held_out")
           .join(lab, "doc_id").groupBy("toxic", "predicted").count().collect())
    n = {(r.toxic, r.predicted): r["count"] for r in out}
    assert n[1, 1] >= 0.8 * (n[1, 1] + n.get((1, 0), 0))
    assert n.get((0, 1), 0) <= 0.005 * n[0, 0]


def test_weights_match_plain_ftrl():
    """The published update, a coordinate at a time, in dictionaries."""
    import math
    rows, lab = planted(120)
    texts, y = [t for _, t in rows], [x for _, _, x in lab]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts), "y": pa.array(y, pa.int32())})
    got, = tox._train(16)(iter([batch]))
    got = dict(zip(got.column(0).to_pylist(), got.column(1).to_pylist()))

    own = []
    for t in texts:
        (_, text, offsets), = wb.blocks(pa.array([t]))
        own.append(sorted(set(tox._features(text, offsets, 16)[1].tolist())))
    often = {s for s in {s for d in own for s in d} if sum(s in d for d in own) >= tox.MIN_DOCS}
    own = [[s for s in d if s in often] for d in own]
    z, n = {-1: 0.0}, {-1: 0.0}

    def weight(s):
        l1, l2 = (0.0, 0.0) if s == -1 else (tox.L1, tox.L2)
        zs = z.get(s, 0.0)
        if s != -1 and abs(zs) <= l1:
            return 0.0
        return -(zs - math.copysign(l1, zs)) / ((tox.BETA + math.sqrt(n.get(s, 0.0))) / tox.ALPHA + l2)
    last = 0.0
    for epoch in range(tox.EPOCHS):
        for d in np.random.Generator(np.random.PCG64(epoch)).permutation(len(own)):
            w = {s: weight(s) for s in [-1, *own[d]]}
            last = w[-1]
            p = 1 / (1 + math.exp(-sum(w.values())))
            g = p - y[d]
            for s, ws in w.items():
                sigma = (math.sqrt(n.get(s, 0.0) + g * g) - math.sqrt(n.get(s, 0.0))) / tox.ALPHA
                z[s] = z.get(s, 0.0) + g - sigma * ws
                n[s] = n.get(s, 0.0) + g * g
    want = {s: weight(s) for s in often if weight(s)} | {-1: last}
    assert set(got) == set(want) and len(want) < len(often) / 2        # sparse
    assert all(abs(got[s] - x) < 1e-9 for s, x in want.items())
