"""One registered query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stockroom.llm import (
    bpe,
    decontaminate,
    embeddings,
    filter_audit,
    licenses,
    lines,
    minhash,
    mixing,
    oracle,
    quality,
    ranked_search,
    sharding,
    suffixes,
    warc,
)
from stockroom.sources.tables import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(suffixes.remove_repeats(read_table(spark, sf_dir, "documents")))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return quality.score_documents(docs, labels)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_pages(spark, read_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(read_table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), 40)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(read_table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(bpe.encode_documents(read_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN))


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(decontaminate.find_passages(docs, benchmark))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OPERATORS = (
    op1_suffix_dedup,
    op2_quality_rules,
    op3_warc,
    op4_licenses,
    op5_minhash,
    op6_line_dedup,
    op7_sharding,
    op8_mixing,
    op9_bpe,
    op10_embeddings,
    op11_decontaminate,
    op12_filter_audit,
    op13_ranked_search,
)
QUERIES: dict[str, QueryFn] = {f.__name__: f for f in OPERATORS}
ORACLE: dict[str, str] = oracle.SQL
