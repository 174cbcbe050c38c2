from __future__ import annotations

import pytest
from corpus_cases import LOWER, WORD, changed, colliding, docs, odd_rows, prose

from eventide.llm import ngram_join as nj


def brute(rows, size, percent):
    """{row number: (set size, component's smallest id)} by comparing all pairs."""
    sets = []
    for i, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size
                    else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * len(sets[a] | sets[b]):
                up[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return [(i, len(sets[k]), low[find(k)] if i is not None else None)
            for k, (i, _) in enumerate(rows)]


def groups():
    """Chains and clouds of near copies, a passage shared by unrelated texts."""
    rows, at = [], 0
    for g in range(6):
        base = prose(g, 60 + 20 * g)
        for k in range(14):
            rows.append((at, changed(base, 100 * g + k, k % 7)))
            at += 3
    step = prose(99, 90)
    for k in range(10):                     # each links to its neighbours only
        rows.append((at, step))
        step = changed(step, k, 1)
        at += 1
    passage = prose(77, 60)
    for k in range(25):
        rows.append((at, passage + " " + prose(1000 + k, 15 + 3 * k)))
        at += 1
    return rows


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80), (3, 55)])
def test_components_match_all_pairs(spark, size, percent):
    rows = groups() + odd_rows()
    found = nj.similar_groups(docs(spark, rows), size, percent)
    assert got(found) == sorted(brute(rows, size, percent), key=str)


def test_longer_prefixes_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(nj, "MAX_COST", 2)
    monkeypatch.setattr(nj, "STAR_ROUNDS", 1)
    rows = groups()
    assert got(nj.similar_groups(docs(spark, rows), 4, 80)) == sorted(brute(rows, 4, 80), key=str)


def test_prefixes_share_what_they_promise():
    for share in nj.LEVELS:
        for n in (1, 2, 7, 40, 333):
            assert nj.matches(n, 85, share) <= nj.need(n, 85)
            assert 1 <= nj.prefix_length(n, 85, share) <= n
    assert nj.prefix_length(100, 85, 1.0) == 100 and nj.matches(100, 85, 1.0) == 85


def test_connected_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(100, 90), (90, 95), (5, 5)],
                                  "a long, b long")
    roots = {r.node: r.root for r in nj.components(links).collect()}
    assert roots == {**{k: 1 for k in range(1, 41)}, 90: 90, 95: 90, 100: 90}
    assert nj.components(links.limit(0)).count() == 0


def test_one_document_of_each_group_stays(spark):
    rows = groups() + [(i and i + 10000, t) for i, t in odd_rows()] + [(9000, groups()[0][1])]
    table = docs(spark, rows)
    kept = nj.one_per_group(table, 4, 85)
    assert kept.columns == table.columns
    want = {c for _, n, c in brute(rows, 4, 85) if c is not None}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want)
    assert ids.count(None) == 1


def test_equal_ids_with_different_texts(spark):
    a, b = prose(1, 50), prose(2, 50)
    rows = [(5, a), (5, b), (3, b), (5, a)]
    table = docs(spark, rows)
    assert sorted(r.component_id for r in nj.similar_groups(table, 4, 85).collect()) == [3, 3, 5, 5]
    assert sorted((r.doc_id, r.text) for r in nj.one_per_group(table, 4, 85).collect()) == [
        (3, b), (5, a)]


def test_empty_table(spark):
    empty = docs(spark, [(1, "x")]).limit(0)
    assert nj.similar_groups(empty, 4, 85).count() == 0
    assert nj.one_per_group(empty).count() == 0


def test_long_words_of_one_hash_stay_apart(spark):
    rows = []
    for k, n in enumerate((1024, 4096, 100_352)):
        one, two = colliding(n)
        rows += [(10 * k, one), (10 * k + 1, two), (10 * k + 2, one),
                 (10 * k + 3, f"x y z {one} v w"), (10 * k + 4, f"x y z {two} v w")]
    assert got(nj.similar_groups(docs(spark, rows), 4, 85)) == sorted(brute(rows, 4, 85), key=str)
