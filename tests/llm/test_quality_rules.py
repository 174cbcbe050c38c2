from __future__ import annotations

import re

import numpy as np
from conftest import SF_SMALL
from corpus_cases import WORD, colliding, docs, odd_rows, prose

from eventide.llm import quality_rules as qr
from eventide.llm.common import table


def base(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    covered = {k + s for k, g in enumerate(grams) if grams.count(g) > 1 for s in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def texts():
    junk = " ".join(f"{w}###" if k % 2 else f"{w}%%%" for k, w in enumerate(prose(1, 90).split()))
    return [(20, "a b c a b c\nx\nx\n\n \n x" * 9), (21, prose(4, 60)), (22, junk),
            (23, "the cat sat the cat sat " * 12), (24, "ab cd   ef" * 30)]


def test_base_statistics_match_brute_force(spark):
    rows = odd_rows()[:8] + odd_rows()[9:] + texts()
    out = qr.quality(docs(spark, rows), labels(spark, [(21, 1, 0)])).collect()
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(str((r.doc_id, *(r[c] for c in cols))) for r in out) == sorted(
        str((i, *base(t))) for i, t in rows)


def test_long_repetitive_text(spark):
    r = qr.quality(docs(spark, [(8, "long " * 30000)]), labels(spark, [])).first()
    assert (r.n_words, r.n_repeat_words, r.base_failed, r.kept) == (30000, 30000, True, False)


def test_ratio_matches_plain_counts(spark):
    rows = [(k, prose(k, 80)) for k in range(12)] + [
        (100 + k, " ".join(w + "***" for w in prose(50 + k, 80).split())) for k in range(6)]
    good = labels(spark, [(k, 1, 0) for k in range(12)] + [(100 + k, 0, 0) for k in range(6)])
    model = qr.fit(docs(spark, rows), good)
    from collections import Counter
    import pyarrow as pa
    from eventide.llm import wordbytes as wb
    raw, target = Counter(), Counter()
    for i, t in rows:
        for _, text, offsets in wb.blocks(pa.array([t])):
            for s in qr._buckets(text, offsets)[1].tolist():
                raw[s] += 1
                target[s] += i < 100
    n, m = sum(raw.values()), sum(target.values())
    for s in list(raw)[:50]:
        p = (raw[s] + 1) / (n + qr.BUCKETS)
        want = np.log((target[s] + 0.01 * m * p) / (1.01 * m) / p)
        assert abs(model.ratio[s] - want) < 1e-9
    out = {r.doc_id: r.kept for r in qr.quality(docs(spark, rows), good).collect()}
    assert out == {i: i < 100 for i, _ in rows}


def test_given_table_rejects_junk_and_keeps_clean(spark):
    d, lab = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    out = qr.quality(d, lab).join(lab, "doc_id").where("not base_failed").collect()
    good = [r.kept for r in out if r.quality == 1]
    bad = [r.kept for r in out if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_without_labels_and_empty(spark):
    d = docs(spark, [(21, prose(4, 60)), (4, "one")])
    none = labels(spark, [])
    assert {r.doc_id: r.kept for r in qr.quality(d, none).collect()} == {21: True, 4: False}
    kept = qr.kept_documents(d, none)
    assert kept.columns == d.columns and [r.doc_id for r in kept.collect()] == [21]
    assert qr.quality(d.limit(0), none).count() == 0


def test_every_labelled_row_counts(spark):
    rows = [(k, prose(k, 80)) for k in range(40)] + [
        (100 + k, " ".join(w + "***" for w in prose(50 + k, 80).split())) for k in range(20)]
    good = labels(spark, [(k, 1, 0) for k in range(40)] + [(100 + k, 0, 0) for k in range(20)])
    more = good.unionByName(spark.range(1000, 101000).selectExpr(
        "id as doc_id", "1 as quality", "0 as toxic"))       # labels of no document here
    want, got = qr.fit(docs(spark, rows), good), qr.fit(docs(spark, rows), more)
    assert (got.ratio == want.ratio).all() and got.threshold == want.threshold > -np.inf


def test_threshold_of_counts_matches_plain_values():
    r = np.random.default_rng(3)
    value = np.sort(r.normal(size=400))
    good, bad = r.integers(0, 9, 400) * (value > -0.5), r.integers(0, 9, 400) * (value < 0.3)
    plain, other = np.repeat(value, good), np.repeat(value, bad)
    floor = np.quantile(plain, qr.KEEP) - qr.MARGIN * plain.std()
    tries = np.concatenate([[-np.inf], (value[1:] + value[:-1]) / 2])
    cost = [10 * (plain < x).mean() + (other >= x).mean() for x in tries]
    assert abs(qr.choose_threshold(value, good, bad) - min(floor, tries[np.argmin(cost)])) < 1e-9


def test_long_words_of_one_hash_are_no_repetition(spark):
    rows = []
    for k, n in enumerate((1024, 4096, 100_352)):
        one, two = colliding(n)
        rows += [(10 * k, f"p q {one} p q {two} p q"), (10 * k + 1, f"p q {one} p q {one} p q")]
    out = qr.quality(docs(spark, rows), labels(spark, [])).collect()
    assert {r.doc_id: r.n_repeat_words for r in out} == {i: base(t)[4] for i, t in rows}
