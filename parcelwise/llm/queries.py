"""One query per operator, with its production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.llm import bpe, divergence, embeddings, licenses, mixing, packing, pii, quality, secrets, simhash, urls, variants, warc
from parcelwise.llm.oracles import ORACLE  # noqa: F401 (a part of the registry)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_links(table(spark, sf_dir, "embeddings"))


def op2_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_report(table(spark, sf_dir, "documents"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), packing.words())


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality_rules(table(spark, sf_dir, "documents"), quality.trusted(table(spark, sf_dir, "labels")))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select(F.col("_row")["doc_id"].alias("doc_id"), *counts, "base_failed", "kept", "score")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.token_report(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archive_pages(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = variants.document_words(table(spark, sf_dir, "documents"), noise=variants.NOISE)
    return variants.spelling_variants(words)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_pii_disclosure": op2_pii_disclosure,
    "op3_url_filters": op3_url_filters,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_quality_rules": op5_quality_rules,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_license_scan": op7_license_scan,
    "op8_secret_scan": op8_secret_scan,
    "op9_simhash_dedup": op9_simhash_dedup,
    "op10_warc_archives": op10_warc_archives,
    "op11_cube_mixing": op11_cube_mixing,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_source_divergence": op13_source_divergence,
}
