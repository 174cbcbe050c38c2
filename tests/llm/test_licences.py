from __future__ import annotations

import random
import re

from conftest import SF_SMALL
from corpus_cases import LOWER, docs, odd_rows, prose

from eventide.llm import licences
from eventide.llm.common import table

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def base(text):
    words = WORD.findall((text or "").translate(LOWER))
    places = []
    for phrase, label in licences.BASE_PHRASES:
        q = phrase.split()
        places += [(k, label) for k in range(len(words) - len(q) + 1) if words[k:k + len(q)] == q]
    starts = [k for k, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in places})))


def rows_of(df):
    return sorted(str((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels))
                  for r in df.collect())


def test_base_places_match_brute_force(spark):
    rows = odd_rows() + [
        (20, "MIT License, mit-license; MIT\nLICENSE mit licenses"), (21, "The Apache_License 2"),
        (22, "general public license general public license"), (23, "general public"), (24, "license mit"),
        (25, "x" * 50 + " mit license " + "y" * 2000000), (26, "mit"), (27, "license")]
    out = licences.scan(docs(spark, rows))
    assert rows_of(out) == sorted(str((i, *base(t))) for i, t in rows)


def test_given_table(spark):
    d = table(spark, SF_SMALL, "documents")
    assert rows_of(licences.scan(d)) == sorted(str((r.doc_id, *base(r.text))) for r in d.collect())


def notice(label, fill="Some One"):
    return f" {fill} ".join(dict((n, parts) for n, parts, _ in licences.TEMPLATES)[label])


def plain(text):
    return " ".join(WORD.findall(text.translate(LOWER)))


def scanned(spark, texts):
    return {r.doc_id: r for r in licences.scan(docs(spark, list(enumerate(texts)))).collect()}


def extra(row):
    return set(row.labels.split(",")) - set(row.base_labels.split(",")) - {""}


LABELS = [label for label, _, _ in licences.TEMPLATES]


def test_every_notice_is_found_where_it_stands(spark):
    assert len(set(LABELS)) >= 25
    texts = [prose(k, 40) + " " + notice(label).upper() + " " + prose(100 + k, 40)
             for k, label in enumerate(LABELS)] + [prose(200 + k, 120) for k in range(30)]
    out = scanned(spark, texts)
    for k, label in enumerate(LABELS):
        assert label in extra(out[k]) and out[k].score > 0.9, label
        # nothing beside it but notices whose words it holds
        assert extra(out[k]) <= {label} | {n for n, parts, _ in licences.TEMPLATES if all(
            plain(p) in plain(notice(label)) for p in parts)}, label
    assert all(out[k].labels == "" and out[k].score == 0 for k in range(len(LABELS), len(texts)))
    assert extra(out[LABELS.index("bsd-3-clause")]) == {"bsd-3-clause"}
    assert extra(out[LABELS.index("x11")]) == {"x11"} and extra(out[LABELS.index("mit-text")]) == {"mit-text"}


def naive(text, index):
    """Labels and scores by trying every offset of every part, and every choice of
    alignments."""
    words = [licences._hashed(x)[0] for x in WORD.findall(text.translate(LOWER))]
    scores = {}
    idf = dict(zip(index.hashes.tolist(), index.idf.tolist()))
    for t, parts in enumerate(index.parts):
        found = []
        for p in parts:
            seq = [(at, h) for h, posts in zip(index.hashes.tolist(), index.postings)
                   for q, at in posts if q == p]
            votes = {d: sum(idf[h] for at, h in seq if 0 <= d + at < len(words) and words[d + at] == h)
                     for d in range(-index.length[p], len(words))}
            hits = []
            for d, own in votes.items():
                total = sum(votes.get(d + s, 0) for s in range(-licences.SLIP, licences.SLIP + 1))
                part = words[max(0, d - licences.SLIP):max(0, d + index.length[p] + licences.SLIP)]
                held = all(any(part[k:k + len(key)] == list(key) for k in range(len(part)))
                           for key in index.keys[p])
                if own > 0 and total >= licences.MIN_MASS * index.mass[p] and held:
                    hits.append((d, d + index.length[p], min(1.0, total / index.mass[p]) * index.mass[p]))
            found.append(hits)
        if any(index.keys[p] and not hits for p, hits in zip(parts, found)):
            continue

        def most(k, after):
            if k == len(found):
                return 0.0
            return max([most(k + 1, after)] + [w + most(k + 1, b) for a, b, w in found[k]
                                               if after is None or after <= a + 2 * licences.SLIP])
        share = most(0, None) / sum(index.mass[p] for p in parts)
        if share >= licences.MIN_TEMPLATE:
            scores[index.label[t]] = min(1.0, share)
    kept = set(scores) - {x for n in scores for x in licences.EXTENDS.get(n, ())}
    return kept, max((scores[n] for n in kept), default=0.0)


def test_planted_slipped_and_cut_notices_match_brute_force(spark):
    r = random.Random(7)
    texts = []
    for k, label in enumerate(LABELS):
        text = notice(label)
        words = text.split()
        slipped = words[:]
        for _ in range(max(1, len(words) // 12)):               # words lost, added and changed
            at = r.randrange(len(slipped))
            slipped[at:at + 1] = r.choice([[], [slipped[at], "zq"], ["zq"]])
        cut = words[:int(len(words) * r.uniform(0.3, 0.9))]
        shuffled = words[:]
        r.shuffle(shuffled)
        texts += [text, " ".join(slipped), " ".join(cut), " ".join(shuffled)]
        if k % 5 == 0:
            texts.append(prose(k, 10) + " " + " ".join(cut) + " " + prose(k + 1, 5) + " " + text)
    d = docs(spark, list(enumerate(texts)))
    index = licences.build_index(licences.corpus_idf(d))
    out = {x.doc_id: x for x in licences.scan(d).collect()}
    found = 0
    for k, text in enumerate(texts):
        want, score = naive(text, index)
        assert extra(out[k]) == want, (k, text)
        assert abs(out[k].score - score) < 1e-9, (k, text)
        found += bool(want)
    assert found > 2 * len(LABELS) and found < len(texts)


def test_parts_in_order():
    a, b, c = [(0, 10, 5.0), (50, 60, 5.0)], [(20, 30, 3.0)], [(12, 18, 4.0), (61, 70, 2.0)]
    assert licences.in_order([a, b, c]) == 10.0          # 0-10, 20-30, 61-70
    assert licences.in_order([c, b, a]) == 12.0          # 12-18, 20-30, 50-60
    assert licences.in_order([[], [], []]) == 0.0


def test_key_phrase_and_order_are_required(spark):
    bsd = notice("bsd-2-clause")
    out = scanned(spark, [" ".join(reversed(bsd.split())),
                          bsd.replace("source and binary forms", "binary and source forms"),
                          bsd.replace("conditions are met", "conditions be met"), bsd + " " + bsd])
    assert [extra(out[k]) for k in range(4)] == [set(), set(), {"bsd-2-clause"}, {"bsd-2-clause"}]


def test_empty_table(spark):
    assert licences.scan(docs(spark, [(1, "x")]).limit(0)).count() == 0
