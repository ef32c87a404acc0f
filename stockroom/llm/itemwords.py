"""Words of whole texts as 64-bit keys, and small tables of texts in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_RANDOM = np.random.default_rng(20260501)
#: A random number for each byte; 0 marks bytes that are in no word. Upper case counts as lower case.
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[:0x30] = _BYTE[0x3A:0x41] = _BYTE[0x5B:0x61] = _BYTE[0x7B:0x80] = 0
_BYTE[0x41:0x5B] = _BYTE[0x61:0x7B]
_PLACE = _RANDOM.integers(0, 1 << 63, 1 << 12, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts of a column, one after the other, and the n + 1 places where
    they start and end; a null text is empty."""
    return binary_bytes(pa.compute.fill_null(column, ""))


def binary_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``text_bytes`` of a column of texts or byte strings without nulls."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return held, bounds - bounds[0]


def word_keys(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, starts, ends) of the words of concatenated texts: maximal runs of 0-9, A-Z, a-z and
    characters beyond ASCII, in order. Words that differ only in the case of A-Z have equal keys;
    others differ, but for one pair in 2 ** 63."""
    values = _BYTE[data]
    inside = values > 0
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True  # a word ends with its text
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & (~before | edge[:-1])) if len(data) else np.zeros(0, np.int64)
    after = np.concatenate([inside[1:], [False]])
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1 if len(data) else np.zeros(0, np.int64)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends
    sizes = ends - starts
    kept = values[inside]
    firsts = np.cumsum(sizes) - sizes
    at = np.arange(len(kept)) - np.repeat(firsts, sizes)
    far = at >> 12  # words of over 4,096 bytes: the block number is mixed in
    mixed = kept * _PLACE[at & 4095]
    if far.any():
        mixed += far.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) * kept
    mixed ^= mixed >> np.uint64(31)
    keys = np.add.reduceat(mixed * np.uint64(0xBF58476D1CE4E5B9), firsts)
    return keys ^ (keys >> np.uint64(29)), starts, ends


def item_blocks(items: DataFrame, most_bytes: int) -> Iterator[tuple[list, pa.Array]]:
    """(item_ids, texts) of all rows of ``items`` in blocks of at most ``most_bytes`` bytes of text
    (a longer text is a block of its own). Rows come one partition at a time and one block is held
    at once, so the driver's memory does not grow with the number of items; a row counts 64 bytes
    besides its text. An empty table gives no block."""
    ids, texts, held = [], [], 0
    for row in items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).toLocalIterator():
        size = len(row.text.encode()) + 64
        if ids and held + size > most_bytes:
            yield ids, pa.array(texts, pa.large_string())
            ids, texts, held = [], [], 0
        ids.append(row.item_id)
        texts.append(row.text)
        held += size
    if ids:
        yield ids, pa.array(texts, pa.large_string())


def numbered(keys: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """For each key its place in the sorted ``vocabulary``, -1 if it is not there."""
    if not len(vocabulary):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(vocabulary, keys), len(vocabulary) - 1)
    return np.where(vocabulary[at] == keys, at, -1)
