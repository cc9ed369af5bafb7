"""Registered queries of this subpackage: one for each operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recforge.llm import (
    arrowfile, audit, bpe, classlm, decontam, licenses, pii, quality, repeats, simhash, tokencount, trie, warc)
from recforge.llm.common import scratch, table
from recforge.llm.words import tokenizer_path


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.encode(docs, tokenizer_path("word_bpe_49k.json"), bpe.digests, bpe.DIGESTS_DDL)


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s.base)
    labels = lambda spans: F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(spans, lambda s: s.label))))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(F.transform(base, lambda s: s.start)).alias("first_word"),
        F.array_max(F.transform(base, lambda s: s.start)).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s.score)), F.lit(0.0)).alias("score"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = quality.judge(table(spark, sf_dir, "documents"), measures=measures)
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select("doc_id", *measures, base.alias("base_failed"), "kept")


def op4_arrow_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = arrowfile.write_ids(docs, tokenizer_path("byte_bpe_50k.json"), scratch(spark, "ids"))
    return arrowfile.read_digests(index)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    base = pii.listed(pii.of_kinds(F.col("spans"), pii.BASE))
    counts = [F.size(pii.of_kinds(F.col("spans"), (k,))).cast("bigint").alias(f"n_{k.name}") for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"),
                        pii.listed(F.col("spans")).alias("spans"))


def op6_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classlm.score(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counts = tokencount.count_tokens(docs, tokenizer_path("byte_bpe_50k.json"), scratch(spark, "counts"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: whether it is contaminated, by which items, and the largest coverage among these."""
    return decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return warc.read_pages(warc.write(pages, scratch(spark, "warc")), pages)


def op13_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_bpe, op2_licenses, op3_quality, op4_arrow_ids, op5_pii, op6_class_lm, op7_token_counts, op8_repeats,
    op9_simhash, op10_decontamination, op11_conversation_trie, op12_warc, op13_audit)}
