"""The corpus pipeline: five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of ``documents``, and any
other columns that ``docs`` has, whatever their names. An empty table gives an empty result in every
stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stockroom.llm import bpe, lines, minhash, mixing, quality
from stockroom.session import materialize
from stockroom.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or score too low go; null and empty texts have too few words.
    Each row is judged on its own, so equal rows and null ids share no fate but that of their text."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of repeated three-line windows go but for the first occurrence, by doc_id (null first), then
    by the MD5 of the text. Equal rows are one document; a text that loses its last word goes; a null
    or empty text stays as it is."""
    return lines.without_later_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays, that with the smallest doc_id (null last), of
    repeated rows one; texts without words, null ones among them, are in no group and stay."""
    return minhash.keep_first(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat or drop out so that sources, a null one among them, have their target weights;
    texts without words drop out; equal rows share their copies evenly."""
    return mixing.draw_mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of each row of the mix, with digests of the ids and of their decoding; a null
    text is an empty one."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("bpe", tokens),
]

#: SQL cannot express the encoding; the tests hold each stage against its own SQL or the library.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
