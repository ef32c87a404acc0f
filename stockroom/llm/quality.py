"""Quality rules: base rules and an n-gram likelihood ratio.

Words and word pairs are hashed into a fixed number of buckets. The trusted multinomial comes from
documents labelled good, the raw one from all documents. A document's score is the sum of the log
ratios of its features divided by their number; it is kept if the score reaches a threshold. Log
ratios are rounded to whole millionths once, so sums are exact in any order and reruns agree.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.llm.arrowtext import text_chunks

BUCKETS = 1 << 16
TARGET_ROWS = 20_000
THRESHOLD = -0.16
#: Added to a bucket's trusted count and to the count that the raw corpus would lead one to expect:
#: a rare bucket says little, so a small trusted sample does not speak against rare words.
PRIOR = 10
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MICRO = 1_000_000
_CACHE = 400_000

SCORED = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_features long, score_micro long"


class WordIds:
    """64-bit ids of words from MD5; a bounded cache keeps the frequent ones."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > _CACHE:
            known.clear()
        for word in set(words).difference(known):
            known[word] = int.from_bytes(hashlib.md5(word, usedforsecurity=False).digest()[:8], "little")
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def features(ids: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of all words and all pairs of neighbouring words."""
    low = (ids & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return np.concatenate([low, low[:-1] * 31 + low[1:]]) % buckets


def repeated_words(ids: np.ndarray, width: int = 5) -> int:
    """Words that lie in a ``width``-word window that occurs twice or more."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    keys = np.zeros(n, np.uint64)
    for i in range(width):
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + ids[i : i + n]
        keys ^= keys >> np.uint64(29)
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    edge = np.zeros(len(ids) + 1, np.int64)
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    edge[:n] += twice
    edge[width : width + n] -= twice
    return int((np.cumsum(edge)[:-1] > 0).sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    return len(lines) - len(set(lines))


def bucket_counts(docs: DataFrame, trusted: set[int], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, raw, good): features of all documents and of the trusted ones. Each task sends one
    row for each bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, raw, good = WordIds(), np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in text_chunks(batches):
            held = [[], []]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = (text or "").encode().split()
                if words:
                    held[doc in trusted].append(features(ids(words), buckets))
            for arrays, into in ((held[0], [raw]), (held[1], [raw, good])):
                if arrays:
                    found = np.bincount(np.concatenate(arrays), minlength=buckets)
                    for counts in into:
                        counts += found
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(good[used])], ["bucket", "raw", "good"])

    counted = docs.select("doc_id", "text").mapInArrow(count, "bucket long, raw long, good long")
    return counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good"))


def log_ratios(counts: list[tuple[int, int, int]], buckets: int = BUCKETS) -> np.ndarray:
    """For each bucket the log of its trusted frequency over its raw one, both with ``PRIOR`` more
    features at the size of the trusted sample, in millionths; all 0 without trusted features."""
    out = np.zeros(buckets, np.int64)
    n_raw, n_good = (sum(c[i] for c in counts) for i in (1, 2))
    if n_good:
        for bucket, raw, good in counts:
            expected = float(raw) * float(n_good) / float(n_raw)
            out[bucket] = math.floor(math.log((good + PRIOR) / (expected + PRIOR)) * MICRO + 0.5)
    return out


def trusted_ids(labels: DataFrame, rows: int = TARGET_ROWS) -> set[int]:
    """Ids labelled as good and nowhere as bad or toxic: the ``rows`` first by MD5 of the id. The
    trusted sample is bounded by this parameter; corpus counts and scores are not."""
    fine = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).alias("good"))
    order = F.md5(F.col("doc_id").cast("string"))
    return {r[0] for r in fine.where("good").orderBy(order, "doc_id").limit(rows).select(F.col("doc_id").cast("long")).collect()}


def _judge(batch: pa.RecordBatch, ids: WordIds, llr: np.ndarray, floor: int) -> list[tuple]:
    rows = []
    for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
        text = text or ""
        words = text.encode().split()
        n = len(words)
        found = ids(words)
        used = features(found, len(llr)) if n else np.zeros(0, np.int64)
        total, repeats = int(llr[used].sum()), repeated_words(found)
        failed = n < 10 or 100 * repeats > 20 * n
        chars = len(text) - sum(map(text.count, SPACE))
        rows.append((doc, n, chars, sum(map(text.count, SYMBOLS)), duplicate_lines(text), repeats, failed, not failed and total >= floor * len(used), len(used), total))
    return rows


def _fitted(docs: DataFrame, labels: DataFrame, target_rows: int, buckets: int):
    """The log ratios as a broadcast: one number for each bucket."""
    sums = bucket_counts(docs, trusted_ids(labels, target_rows), buckets)
    return docs.sparkSession.sparkContext.broadcast(log_ratios([tuple(r) for r in sums.collect()], buckets))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, target_rows: int = TARGET_ROWS, buckets: int = BUCKETS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) with the columns of ``SCORED``.

    A null or empty text has no words and fails the base rules. Without trusted documents every
    score is 0 and the base rules decide. A null doc_id is never trusted. Repeated rows are scored
    alike. An empty table gives an empty result. Other columns are not read. Two passes over the
    texts, no shuffle of texts; what returns to the driver is one row for each bucket.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ratios, floor = _fitted(docs, labels, target_rows, buckets), math.floor(threshold * MICRO)
    kinds = pa.schema([(x.split()[0], {"long": pa.int64(), "boolean": pa.bool_()}[x.split()[1]]) for x in SCORED.split(", ")])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds()
        for batch in text_chunks(batches):
            rows = _judge(batch, ids, ratios.value, floor)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k.type) for c, k in zip(zip(*rows), kinds)], schema=kinds)

    return docs.mapInArrow(score, SCORED)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, target_rows: int = TARGET_ROWS, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``docs`` that ``score_documents`` keeps, with all their columns; each row is
    judged on its own, so repeated and null ids need no care, and equal rows all stay or all go.
    Null and empty texts have too few words and go; an empty table gives an empty result."""
    ratios, floor = _fitted(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels, target_rows, buckets), math.floor(threshold * MICRO)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds()
        for batch in text_chunks(batches):
            yield batch.filter(pa.array([row[7] for row in _judge(batch, ids, ratios.value, floor)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
