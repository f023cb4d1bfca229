"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read again.

1. language ID: texts that are rejected or have no letter go;
2. near copies: of each group of texts that are alike (5-grams, similarity 0.8) the one with the least id stays;
3. benchmark decontamination: texts with a benchmark passage go;
4. personal data: spans become ``[KIND]``;
5. encoding: token ids, and hashes of the ids and of the text decoded from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import bpe_trie, decontaminate, langid, ngram_join, pii
from riskloom.llm.common import cut, load
from riskloom.llm.queries import tokenizer_file


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs, langid.fit_documents(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, load(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_trie.encode(docs, tokenizer_file(), with_ids=True).drop("decoded")


STAGES = [
    ("language_id", language_id),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]

#: No SQL for a fitted classifier, MinHash, an SVD or a tokenizer; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
