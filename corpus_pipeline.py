"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; `run` writes it as Parquet to
the shared folder and reads it again as the next one's docs. All but the last give the columns
of their input.

1. toxicity: documents that score 0.7 or more go.
2. line dedup: later copies of line runs of 50 words or more go; a document may end up empty.
3. near-duplicates: of each class the document with the smallest doc_id stays.
4. secret scan: secrets are masked.
5. packing: the pieces of all documents that are left, in sequences of 2048 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from footfall.llm import dart_minhash, line_dedup, packing, secret_scan, toxicity
from footfall.llm.common import staged, table
from footfall.llm.queries import tokenizer_file


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dart_minhash.kept(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("near duplicates", without_near_duplicates),
    ("secret scan", without_secrets),
    ("packing", packed),
]

#: SQL expresses none of these stages; tests compare them with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
