"""The registered queries of this subpackage; each takes a session and a folder of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from footfall.llm import bpe, dart_minhash, html_extract, license_scan, line_dedup, mask_search, oracles, oracles_words, packing
from footfall.llm import posting_lists, quality, secret_scan, spotsigs, toxicity, variants
from footfall.llm.common import table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.deduplicated(docs, counts=True)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op3_bpe_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), reread=True)


def op4_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op9_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0, k=20)


def op10_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprints(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_mask_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that SQL can express; tests compare the others with plain Python."""
    return oracles.oracle_sql() | oracles_words.oracle_sql()
