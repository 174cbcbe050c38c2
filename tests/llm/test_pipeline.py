"""The pipeline end to end, and the operators' SQL on the given tables."""

from __future__ import annotations

import os

import corpus_pipeline
import duckdb
import pytest
import public_tokenizers
from conftest import SF_SMALL
from corpus_cases import changed, docs, odd_rows, prose
from test_ngram_join import brute
from tokenizers import Tokenizer

import __spark_entry__ as entry
from eventide.llm import ngram_join, quality_rules, toxicity
from eventide.llm.common import table
from eventide.llm.queries import QUERIES, SQL

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    cur = con.execute(SQL[name])
    cols = [d[0] for d in cur.description]
    want = sorted((str(r) for r in cur.fetchall()))
    df = QUERIES[name](spark, SF_SMALL)
    assert sorted(df.columns) == sorted(cols)
    assert sorted(str(tuple(r)) for r in df.select(*cols).collect()) == want


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}


def test_stages_keep_columns_and_decide_rows(spark):
    d, lab = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    now = d
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, now, SF_SMALL)
        assert kept.columns == d.columns, name
        ids = {r.doc_id for r in kept.collect()}
        if name == "toxicity":
            want = {r.doc_id for r in toxicity.toxicity_scores(now, lab).collect() if not r.predicted}
        elif name == "quality_rules":
            want = {r.doc_id for r in quality_rules.quality(now, lab).collect() if r.kept}
        else:
            want = {r.component_id for r in ngram_join.similar_groups(now, 5, 80).collect()}
        assert ids == want, name
        now = kept
    pieces = corpus_pipeline.run(spark, SF_SMALL)
    assert {r.doc_id for r in pieces.collect()} == ids


def test_stages_take_odd_and_empty_documents(spark, tmp_path):
    lab = table(spark, SF_SMALL, "labels")
    lab.write.parquet(os.path.join(tmp_path, "labels.parquet"))
    rows = odd_rows() + [(20, prose(1, 80)), (21, prose(1, 80)), (22, changed(prose(1, 80), 3, 1)),
                         (23, None), (None, None)]
    tokens = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    sizes = [len(tokens.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows]
    d = docs(spark, rows)
    want = {
        # none of these is toxic
        "toxicity": [i for i, _ in rows],
        # the others have too few words, or repeat them
        "quality_rules": [20, 21, 22],
        "near_duplicates": [c for c in {c for _, _, c in brute(rows, 5, 80) if c is not None}]
                           + [i for i, _ in rows if i is None],
        "packing": [i for (i, _), n in zip(rows, sizes) for _ in range(0, n, 2048)]}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, d, str(tmp_path))
        assert sorted((r.doc_id for r in out.collect()), key=str) == sorted(want[name], key=str), name
        empty = stage(spark, d.limit(0), str(tmp_path))
        assert empty.count() == 0 and empty.columns == out.columns, name
        assert name == "packing" or out.columns == d.columns
