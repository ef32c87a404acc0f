"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

The shard of a row follows from its key and the number of shards alone: no ring table, no state,
and a new shard takes its share of the rows from all others while no row moves between old ones.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom.llm.running import running_total
from stockroom.session import materialize

_STEP = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, n_shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key, all keys at once. The expected number of rounds is
    the logarithm of ``n_shards``."""
    key = keys.astype(np.uint64)
    shard = np.zeros(len(key), dtype=np.int64)
    jump = np.zeros(len(key), dtype=np.int64)
    live = np.arange(len(key))
    while len(live):
        shard[live] = jump[live]
        k = key[live] * _STEP + np.uint64(1)
        key[live] = k
        step = np.float64(1 << 31) / ((k >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        jump[live] = ((shard[live] + 1) * step).astype(np.int64)
        live = live[jump[live] < n_shards]
    return shard


def shard_of(key: Column, n_shards: int) -> Column:
    """Shard of a long key column; a null key counts as -1."""
    if n_shards < 1:
        raise ValueError("n_shards must be positive")

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(np.int64).view(np.uint64), n_shards))

    return place(F.coalesce(key.cast("long"), F.lit(-1).cast("long")))


def shard_documents(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): size, CRC-32, shard, slot and the shard after
    one more shard is added.

    Size is the UTF-8 length of the text (null: 0) plus 16; the CRC of a null text is that of the
    empty string. Slots number the rows of a shard from 0 without gaps, in order of hashes of the key
    and of the text, so that rows of one key are numbered by many tasks; equal rows take
    neighbouring slots. A null doc_id is a key of its own (-1). An empty
    table gives an empty result, and other columns of ``docs`` are not read. The text itself is
    never shuffled: only the digest of a row is.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = rows.select(
        "*",
        shard_of(F.col("doc_id"), n_shards).alias("shard"),
        shard_of(F.col("doc_id"), n_shards + 1).alias("grown_shard"),
        F.format_string("%02x%02x", F.pmod(F.xxhash64("doc_id"), F.lit(256)), F.shiftright(F.col("text_crc32"), 24)).alias("_part"),
        F.lit(1).cast("long").alias("_one"),
    )
    placed = materialize(placed, "shards")
    numbered = running_total(placed, "shard", "_part", ["doc_id", "text_crc32", "size"], "_one", "slot")
    return numbered.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
