"""The queries of this subpackage, as ``(spark, sf_dir) -> DataFrame``.

Only op13 has an oracle in SQL: the results of the others carry a column that only their method gives (a compression
verdict, a learnt label, token ids, hashes of texts). Their tests hold them against plain versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import bpe_trie, compression, decontaminate, filter_audit, langid, license_rules, ngram_join, pii, secret_scan, spelling, suffix_dedup, token_store, url_trees
from riskloom.llm.common import load
from riskloom.session import scratch_path


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """A public vocabulary of the box; the byte-level BPE if no other is named."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.quality(load(spark, sf_dir, "documents"))


def op2_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_trie.encode(load(spark, sf_dir, "documents"), tokenizer_file())


def op3_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(load(spark, sf_dir, "documents"))


def op4_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trees.judge(load(spark, sf_dir, "pages"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(load(spark, sf_dir, "documents"))


def op6_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rules.scan(load(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(load(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(load(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(load(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op11_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(load(spark, sf_dir, "documents"))


def op12_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-store")
    token_store.write(load(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), path)
    return token_store.read(spark, path, with_ids=False)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filter_audit.failures(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return filter_audit.audit(rows, "ABCDE", "part", ["good", "toxic"]).withColumnsRenamed({"lost_good": "good_lost", "lost_toxic": "toxic_lost"})


QUERIES = {
    f.__name__: f
    for f in (
        op1_compression_bands,
        op2_bpe_trie,
        op3_weak_pii,
        op4_url_trees,
        op5_ngram_join,
        op6_license_rules,
        op7_secret_scan,
        op8_suffix_dedup,
        op9_language_id,
        op10_decontamination,
        op11_spelling_groups,
        op12_token_store,
        op13_filter_audit,
    )
}
ORACLES: dict[str, str] = {"op13_filter_audit": filter_audit.SQL}
