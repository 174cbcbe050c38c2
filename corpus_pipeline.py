"""Corpus pipeline: toxicity, quality rules, near duplicates, packing.

``STAGES`` lists the stages in order. Each takes (spark, docs, sf_dir) and works
on all documents that the stage before it kept; all but the last return the
columns of ``documents``. ``run`` applies them to the whole table and writes each
stage's rows as Parquet before the next one reads them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from eventide.llm import ngram_join, packing, quality_rules, toxicity
from eventide.llm.common import fresh, prepare, table, written

TOKENIZER = "byte_bpe_50k.json"


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    fresh(spark)
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio."""
    fresh(spark)
    return quality_rules.kept_documents(docs, table(spark, sf_dir, "labels"))


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8)."""
    fresh(prepare(spark))
    return ngram_join.one_per_group(docs, size=5, percent=80)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents in token sequences."""
    fresh(prepare(spark))
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("quality_rules", good_quality),
    ("near_duplicates", one_per_group),
    ("packing", packed),
]

#: No SQL: trained weights, hashed counts and tokenizer ids; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
