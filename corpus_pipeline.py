"""From raw documents to token ids: filter, deduplicate, decontaminate, redact, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and reread as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recforge.llm import bpe, decontam, pii, quality, simhash
from recforge.llm.common import table, written
from recforge.llm.words import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles are linked at two differing bits or fewer."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    return pii.redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids: (doc_id, n_tokens, ids)."""
    return bpe.encode(docs, tokenizer_path("word_bpe_49k.json"), bpe.packed, bpe.PACKED_DDL)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]

# Fingerprints, tiling and encoding have no SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
