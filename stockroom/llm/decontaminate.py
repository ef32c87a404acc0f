"""Benchmark decontamination by an FM-index of each training shard.

A task cuts its texts into shards. The words of a shard, numbered by the vocabulary of the test
phrases (all other words share one number), are a sequence whose suffix array gives its
Burrows-Wheeler transform. The transform is held as a wavelet matrix of packed bits; ranks in it
search all phrases backwards at once, and occurrences are located by walking to sampled suffix
positions. Overlapping and neighbouring occurrences merge into spans.

Test phrases come in blocks of bounded size; each block goes to the tasks in one pass. The
training texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.llm.arrowtext import text_chunks
from stockroom.llm.itemwords import item_blocks, numbered, text_bytes, word_keys
from stockroom.session import materialize

#: Words of a phrase: an item's windows, or a whole item of fewer.
WIDTH = 10
#: Bytes of text of a shard, about, and the words of one index; a longer text has several indexes.
SHARD_BYTES = 8 << 20
INDEX_WORDS = 2 << 20
#: Bytes of item texts in a block, and passes between two writes of what was found so far.
BLOCK_BYTES = 4 << 20
PASSES = 4
#: Every so many places of a text a suffix position is kept.
SAMPLE = 32

END, OTHER, FIRST = 0, 1, 2  # symbols: end of a text, a word of no phrase, the first word of the vocabulary
_ONE = np.uint64(1)


# ---- index --------------------------------------------------------------------------------------
class Bits:
    """Packed bits with the number of ones before each block of 64."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        self.blocks = np.concatenate([packed, np.zeros(8 - len(packed) % 8, np.uint8)]).view("<u8")
        ones = np.bitwise_count(self.blocks).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        block, within = at >> 6, (at & 63).astype(np.uint64)
        return self.before[block] + np.bitwise_count(self.blocks[block] & ((_ONE << within) - _ONE))

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self.blocks[at >> 6] >> (at & 63).astype(np.uint64)) & _ONE).astype(bool)


class Wavelet:
    """Wavelet matrix of a sequence of symbols below ``size``: ranks and symbols by place."""

    def __init__(self, symbols: np.ndarray, size: int) -> None:
        self.levels = []
        for shift in range(max(1, int(size - 1).bit_length()) - 1, -1, -1):
            ones = ((symbols >> shift) & 1).astype(bool)
            self.levels.append((shift, Bits(ones), int(len(ones) - ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        self.start = self._down(np.arange(size), np.zeros(size, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where((symbol >> shift) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before the place ``at``, pair by pair."""
        return self._down(symbol, at) - self.start[symbol]

    def read(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol, its rank) at each place."""
        symbol = np.zeros(len(at), np.int64)
        for shift, bits, zeros in self.levels:
            one = bits.get(at)
            ones = bits.rank(at)
            symbol |= one.astype(np.int64) << shift
            at = np.where(one, zeros + ones, at - ones)
        return symbol, at - self.start[symbol]


def suffix_order(symbols: np.ndarray, size: int) -> np.ndarray:
    """Suffixes of a sequence that ends with ``END``, in order; of two suffixes that agree up to an
    ``END``, the earlier is the smaller, so none are equal. Groups of equal first symbols are ordered
    by the groups of what follows, over twice the length each round."""
    n, width = len(symbols), max(1, int(size - 1).bit_length())
    packed = max(1, 62 // width)
    key = np.zeros(n, np.int64)
    ended = np.zeros(n, bool)
    for k in range(packed):
        ahead = np.concatenate([symbols[k:], np.full(min(k, n), END, symbols.dtype)])
        ended |= ahead == END
        key = (key << width) | np.where(ended, END, ahead)
    order = np.argsort(key, kind="stable")
    key, ended = key[order], ended[order]
    last = np.flatnonzero(np.append((key[1:] != key[:-1]) | ended[1:] | ended[:-1], True))
    sizes = np.diff(np.concatenate([[-1], last]))
    group = np.empty(n, np.int64)
    group[order] = np.repeat(last, sizes)
    places = np.flatnonzero(np.repeat(sizes > 1, sizes))
    while len(places):
        members = order[places]
        both = (group[members] << 32) | group[np.minimum(members + packed, n - 1)]
        by = np.argsort(both)
        members, both = members[by], both[by]
        order[places] = members
        last = np.flatnonzero(np.append(both[1:] != both[:-1], True))
        sizes = np.diff(np.concatenate([[-1], last]))
        group[members] = np.repeat(places[last], sizes)
        places = places[np.repeat(sizes > 1, sizes)]
        packed *= 2
    return order


class Index:
    """FM-index of a sequence of symbols (texts, each closed by ``END``)."""

    def __init__(self, symbols: np.ndarray, size: int) -> None:
        order = suffix_order(symbols, size)
        self.total = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=size))])
        self.before = Wavelet(symbols[order - 1], size)  # the first suffix follows the last END
        # starts of texts are kept too: a walk back need not pass an END
        kept = (order % SAMPLE == 0) | (symbols[order - 1] == END)
        self.kept, self.positions = Bits(kept), order[kept]

    def search(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, first, last + 1 place) of the phrases that occur."""
        live = np.arange(len(phrases.lengths))
        symbol = phrases.words[phrases.ends[live] - 1]
        low, high = self.total[symbol], self.total[symbol + 1]
        for back in range(1, int(phrases.lengths.max(initial=0)) + 1):
            found = low < high
            live, low, high = live[found], low[found], high[found]
            more = phrases.lengths[live] > back
            if not more.any():
                break
            symbol = phrases.words[phrases.ends[live[more]] - 1 - back]
            both = self.before.rank(np.concatenate([symbol, symbol]), np.concatenate([low[more], high[more]]))
            low[more], high[more] = np.split(both + np.tile(self.total[symbol], 2), 2)
        found = low < high
        return live[found], low[found], high[found]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The positions in the sequence of places of the suffix array."""
        out, steps = np.empty(len(rows), np.int64), 0
        open_rows = np.arange(len(rows))
        while len(rows):
            done = self.kept.get(rows)
            out[open_rows[done]] = self.positions[self.kept.rank(rows[done])] + steps
            open_rows, rows = open_rows[~done], rows[~done]
            symbol, rank = self.before.read(rows)
            rows = self.total[symbol] + rank
            steps += 1
        return out


# ---- phrases ------------------------------------------------------------------------------------
class Phrases:
    """The different phrases of a block of items: ``words`` holds all items' words as symbols, a
    phrase is the ``lengths`` words before ``ends``; ``owners`` and ``owned`` list the items of each."""

    def __init__(self, ids: list, texts: pa.Array, width: int = WIDTH) -> None:
        data, bounds = text_bytes(texts)
        keys, starts, _ = word_keys(data, bounds)
        self.vocabulary = np.unique(keys)
        self.size = len(self.vocabulary) + FIRST
        self.words = numbered(keys, self.vocabulary) + FIRST
        edge = np.searchsorted(starts, bounds)
        count = np.diff(edge)
        windows = np.where(count > 0, np.maximum(count - width, 0) + 1, 0)
        item = np.repeat(np.arange(len(count)), windows)
        nth = np.arange(len(item)) - np.repeat(np.cumsum(windows) - windows, windows)
        lengths = np.minimum(count, width)[item]
        ends = edge[item] + nth + lengths
        # equal phrases are found by rounds of pairwise numbering, exactly
        code = np.zeros(len(item), np.int64)
        for k in range(int(lengths.max(initial=0))):
            symbol = np.where(k < lengths, self.words[np.maximum(ends - 1 - k, 0)], 0)
            code = np.unique(code * self.size + symbol, return_inverse=True)[1].astype(np.int64)
        _, first, phrase = np.unique(code, return_index=True, return_inverse=True)
        self.ends, self.lengths = ends[first], lengths[first]
        names = ["" if i is None else str(i) for i in ids]
        self.names = sorted(set(names))
        number = {name: k for k, name in enumerate(self.names)}
        owner = np.array([number[name] for name in names], np.int64)[item] if len(item) else np.zeros(0, np.int64)
        pairs = np.unique(phrase.astype(np.int64) * len(self.names) + owner)
        self.owned = pairs % max(1, len(self.names))
        self.owners = np.searchsorted(pairs // max(1, len(self.names)), np.arange(len(self.ends) + 1))

    def occurrences(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, position) of all occurrences in one sequence; indexes of at most ``INDEX_WORDS``
        words overlap by a phrase less one word, so none is lost at a cut."""
        phrase, position = [], []
        longest = int(self.lengths.max(initial=1))
        for start in range(0, max(1, len(symbols) - longest + 1), INDEX_WORDS):
            piece = np.append(symbols[start : start + INDEX_WORDS + longest - 1], END)
            index = Index(piece, self.size)
            found, low, high = index.search(self)
            times = high - low
            rows = np.repeat(low - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
            phrase.append(np.repeat(found, times))
            position.append(index.locate(rows) + start)
        return np.concatenate(phrase), np.concatenate(position)


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sizes = ends - starts
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


SPAN = pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("from_byte", pa.int64()), ("to_byte", pa.int64())])
FOUND = "doc_id long, text string, n_words long, spans array<struct<first_word: long, last_word: long, from_byte: long, to_byte: long>>, items array<string>"


def search_shard(column: pa.Array, phrases: Phrases) -> tuple[np.ndarray, dict[int, list[dict]], dict[int, list[str]]]:
    """For the texts of a shard the number of words, and by place of the text the spans of hit words
    (of texts that have some) and the ids of the items found there."""
    data, bounds = text_bytes(column)
    keys, starts, ends = word_keys(data, bounds)
    edge = np.searchsorted(starts, bounds)
    count, n = np.diff(edge), len(column)
    symbols = np.full(len(keys) + n, END, np.int64)
    text = np.repeat(np.arange(n), count)
    at = np.arange(len(keys)) + text  # an END stands behind each text
    known = numbered(keys, phrases.vocabulary)
    symbols[at] = np.where(known < 0, OTHER, known + FIRST)
    if not len(phrases.ends) or not len(keys):
        return count, {}, {}
    phrase, position = phrases.occurrences(symbols)
    if not len(phrase):
        return count, {}, {}
    change = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(change, position, 1)
    np.add.at(change, position + phrases.lengths[phrase], -1)
    hit = (np.cumsum(change)[:-1] > 0).astype(np.int8)  # an END is never hit, so spans end with their text
    turn = np.diff(hit, prepend=0, append=0)
    first, last = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1) - 1
    word_of = np.cumsum(symbols != END) - 1
    spans: dict[int, list[dict]] = {}
    for a, b in zip(word_of[first].tolist(), word_of[last].tolist()):
        k = int(text[a])
        spans.setdefault(k, []).append(
            {"first_word": a - int(edge[k]), "last_word": b - int(edge[k]), "from_byte": int(starts[a] - bounds[k]), "to_byte": int(ends[b] - bounds[k])}
        )
    where = text[word_of[position]]
    met = np.unique(where * len(phrases.ends) + phrase)
    where, phrase = np.divmod(met, len(phrases.ends))
    times = phrases.owners[phrase + 1] - phrases.owners[phrase]
    owner = phrases.owned[_ranges(phrases.owners[phrase], phrases.owners[phrase + 1])]
    pairs = np.unique(np.repeat(where, times) * len(phrases.names) + owner)
    items: dict[int, list[str]] = {}
    for pair in pairs.tolist():
        k, j = divmod(pair, len(phrases.names))
        items.setdefault(k, []).append(phrases.names[j])
    return count, spans, items


def merged(spans: list[dict]) -> list[dict]:
    """Spans in order, those that overlap or touch made one."""
    out: list[dict] = []
    for span in sorted(spans, key=lambda s: (s["first_word"], s["last_word"])):
        if out and span["first_word"] <= out[-1]["last_word"] + 1:
            if span["last_word"] > out[-1]["last_word"]:
                out[-1] = out[-1] | {"last_word": span["last_word"], "to_byte": span["to_byte"]}
        else:
            out.append(dict(span))
    return out


def _pass(phrases, fresh: bool):
    """A function over Arrow batches whose last columns are the text and, unless ``fresh``, what
    earlier passes found; ``phrases`` is a broadcast variable."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, most=SHARD_BYTES):
            count, spans, items = search_shard(batch.column("text"), phrases.value)
            columns = {c: batch.column(c) for c in ("doc_id", "text")}
            if not fresh:
                for k, (old, names) in enumerate(zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())):
                    if old:
                        spans[k] = merged(spans.get(k, []) + old)
                        items[k] = sorted(set(items.get(k, [])) | set(names))
            columns["n_words"] = pa.array(count, pa.int64())
            columns["spans"] = pa.array([spans.get(k, []) for k in range(len(batch))], pa.list_(SPAN))
            columns["items"] = pa.array([items.get(k, []) for k in range(len(batch))], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return search


def find_passages(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, text, n_words, spans, items.

    ``spans`` are the maximal runs of words that lie in an occurrence of a phrase: words counted
    from 0, last one included, and bytes of the UTF-8 text, end excluded. ``items`` are the ids, as
    strings in order, of the items (item_id, text) with a phrase in the text: any ``width``
    consecutive words of the item, or all of an item that has fewer. Upper case A-Z equals lower
    case. A null or empty text, of either table, has no words and no phrase. Item rows with equal
    ids are one item, a null id is the empty string; repeated document rows and null ids are rows
    like any other. Without items nothing is hit; an empty ``docs`` gives an empty result; other
    columns are not read. Words are compared by 64-bit keys.
    """
    spark: SparkSession = docs.sparkSession
    out, passes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), 0
    for ids, texts in item_blocks(benchmark, block_bytes):
        if passes and passes % PASSES == 0:
            out = materialize(out, "passages")
        block = spark.sparkContext.broadcast(Phrases(ids, texts, width))
        out = out.mapInArrow(_pass(block, passes == 0), FOUND)
        passes += 1
    if not passes:
        nothing = spark.sparkContext.broadcast(Phrases([], pa.array([], pa.large_string()), width))
        out = out.mapInArrow(_pass(nothing, True), FOUND)
    return out


def contamination(found: DataFrame) -> DataFrame:
    """Figures of the rows of ``find_passages``: doc_id, n_words, n_hit, n_items, items_sha256 (of
    the item ids in string order, comma-joined; without any, of the empty string), contaminated."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last_word"] - s["first_word"] + 1)
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def without_passages(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, text) with the spans of ``find_passages`` cut from the texts, bytes of the first to
    the last hit word of each; what stood on both sides stays as it was. A null text stays null."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for k, spans in enumerate(batch.column("spans").to_pylist()):
                if spans:
                    said = texts[k].encode()
                    edges = [0, *(e for s in spans for e in (s["from_byte"], s["to_byte"])), len(said)]
                    texts[k] = b"".join(said[a:b] for a, b in zip(edges[::2], edges[1::2])).decode()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    found = find_passages(docs, benchmark, width).select("doc_id", "text", "spans")
    return found.mapInArrow(cut, "doc_id long, text string")
