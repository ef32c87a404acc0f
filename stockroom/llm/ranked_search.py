"""Ranked lexical search of many queries at once, with shared subexpressions.

The score of a document for an item is a sum over the item's terms, so items that hold the same
terms hold the same partial sums. Shared term sets are mined among the items by pairing: an item's
terms stand in order of how many items hold them, and neighbouring pairs that two or more items
have become a new symbol, round after round. The symbols form a DAG whose inner nodes are partial
document accumulators: each is computed once for a block of documents and used by every item that
holds its set.

1. One pass over the texts keeps, for each document, its length and its frequencies of the items'
   terms, as a table in the shared folder. Corpus figures are sums over that table.
2. A pass over the table evaluates the DAG for blocks of documents and keeps each item's best
   documents of the task; the best of all tasks follow by a ranking per item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from stockroom.llm.arrowtext import text_chunks
from stockroom.llm.itemwords import item_blocks, numbered, text_bytes, word_keys
from stockroom.session import materialize

TOP = 10
#: Bytes of item texts in a block; a block is evaluated in two passes of its own.
BLOCK_BYTES = 4 << 20
#: Accumulator cells (nodes and item symbols times documents) that a task holds at once.
CELLS = 1 << 21
# Fixed values of the score: weights are thousandths, B = 90 of 100, K1 * 1000 = 800.
WEIGHT_UNIT, BLEND, UNIT = 1000, 90, 1_000_000_000


class Sharing:
    """The DAG of a block of items. Symbols below ``n_terms`` are terms; symbol n_terms + k is the sum
    of the symbols left[k] and right[k]. Item i is the sum of symbols[starts[i] : starts[i + 1]].
    ``levels`` lists ranges of inner nodes that depend only on earlier ones."""

    def __init__(self, items: list[np.ndarray], n_terms: int) -> None:
        self.n_terms = n_terms
        held = np.bincount(np.concatenate([np.zeros(0, np.int64), *items]), minlength=n_terms)
        ordered = [t[np.lexsort((t, -held[t]))] for t in items]
        sizes = np.array([len(t) for t in ordered], np.int64)
        symbols = np.concatenate([np.zeros(0, np.int64), *ordered])
        owner = np.repeat(np.arange(len(items)), sizes)
        left, right, self.levels = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
        total = n_terms
        while len(symbols) > 1:
            together = owner[1:] == owner[:-1]
            code = np.where(together, symbols[:-1] * total + symbols[1:], -1)
            _, pair, times = np.unique(code, return_inverse=True, return_counts=True)
            weight = np.where(together, times[pair], 0)
            # the more frequent of two overlapping pairs goes first; in an item all symbols differ
            before = np.concatenate([[0], weight[:-1]]), np.concatenate([[-1], pair[:-1]])
            after = np.concatenate([weight[1:], [0]]), np.concatenate([pair[1:], [-1]])
            best = weight >= 2
            for w, p in (before, after):
                best &= (weight > w) | ((weight == w) & (pair > p))
            chosen = np.flatnonzero(best)
            codes, node, uses = np.unique(code[chosen], return_inverse=True, return_counts=True)
            shared = uses[node] >= 2
            if not shared.any():
                break
            chosen = chosen[shared]
            codes, node = np.unique(code[chosen], return_inverse=True)
            left.append(codes // total)
            right.append(codes % total)
            self.levels.append((total - n_terms, total - n_terms + len(codes)))
            symbols[chosen] = total + node
            kept = np.ones(len(symbols), bool)
            kept[chosen + 1] = False
            symbols, owner = symbols[kept], owner[kept]
            total += len(codes)
        self.left, self.right, self.total = np.concatenate(left), np.concatenate(right), total
        self.symbols, self.starts = symbols, np.searchsorted(owner, np.arange(len(items) + 1))

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """Items x documents from terms x documents."""
        nodes = np.empty((self.total, terms.shape[1]), np.int64)
        nodes[: self.n_terms] = terms
        for start, end in self.levels:
            nodes[self.n_terms + start : self.n_terms + end] = nodes[self.left[start:end]] + nodes[self.right[start:end]]
        out = np.zeros((len(self.starts) - 1, terms.shape[1]), np.int64)
        some = np.flatnonzero(self.starts[1:] > self.starts[:-1])
        if len(some):
            out[some] = np.add.reduceat(nodes[self.symbols], self.starts[some], axis=0)
        return out


def term_counts(docs: DataFrame, vocabulary) -> DataFrame:
    """(doc_id, n, terms, times) of the documents with a term: how many terms the text has, and the
    numbers and frequencies of those in ``vocabulary`` (a broadcast of sorted keys)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            known = vocabulary.value
            data, bounds = text_bytes(batch.column("text"))
            keys, starts, _ = word_keys(data, bounds)
            edge = np.searchsorted(starts, bounds)
            n = np.diff(edge)
            term = numbered(keys, known)
            text = np.repeat(np.arange(len(n)), n)[term >= 0]
            pairs, times = np.unique(text * max(1, len(known)) + term[term >= 0], return_counts=True)
            text, term = np.divmod(pairs, max(1, len(known)))
            used = np.flatnonzero(n > 0)
            ends = np.searchsorted(text, np.append(used, len(n)))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v.astype(np.int32))) for v in (term, times)]
            ids = batch.column("doc_id").take(pa.array(used))
            yield pa.RecordBatch.from_arrays([ids, pa.array(n[used], pa.int64()), *lists], ["doc_id", "n", "terms", "times"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(count, "doc_id long, n long, terms array<int>, times array<int>")


def term_weights(n_docs: int, found: dict[int, int], n_terms: int) -> np.ndarray:
    """The weight of each term from the number of documents that hold it."""
    rare = (2 * n_docs + 2) / np.array([2 * found.get(t, 0) + 1 for t in range(n_terms)], np.float64)
    return np.array([math.floor(WEIGHT_UNIT * math.log(x)) for x in rare.tolist()], np.int64)


class Best:
    """The best ``top`` (score, then smallest id, null last) documents of each item so far."""

    def __init__(self, items: int, top: int) -> None:
        self.top, self.least = top, np.ones(items, np.int64)
        self.rows = [np.zeros(0, np.int64) for _ in range(4)]  # item, -score, no id, id

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.least[:, None])
        if not len(item):
            return
        fresh = (item, -scores[item, doc], no_id[doc], ids[doc])
        rows = [np.concatenate([a, b]) for a, b in zip(self.rows, fresh)]
        order = np.lexsort(rows[::-1])
        rows = [r[order] for r in rows]
        start = np.searchsorted(rows[0], np.arange(len(self.least)))
        nth = np.arange(len(order)) - start[rows[0]]
        self.rows = [r[nth < self.top] for r in rows]
        full = rows[0][nth == self.top - 1]
        self.least[full] = -rows[1][nth == self.top - 1]


def _evaluate(plan, top: int):
    """A function over batches of ``term_counts`` that gives each item's best documents of the task.
    ``plan``: broadcast of (sharing, weights, documents, terms of all documents)."""

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sharing, weights, n_docs, all_terms = plan.value
        best = Best(len(sharing.starts) - 1, top)
        width = int(max(1, min(1024, CELLS // max(1, sharing.total + len(sharing.symbols)))))
        for batch in batches:
            ids = batch.column("doc_id")
            no_id = np.asarray(ids.is_null()).astype(np.int64)
            ids = ids.fill_null(0).to_numpy()
            length = batch.column("n").to_numpy()
            mean = 100 - BLEND + (BLEND * length * n_docs) // all_terms
            listed = batch.column("terms")
            edge = listed.offsets.to_numpy().astype(np.int64)
            term = listed.values.to_numpy().astype(np.int64)
            times = batch.column("times").values.to_numpy().astype(np.int64)
            for start in range(0, len(ids), width):
                end = min(len(ids), start + width)
                part = slice(edge[start], edge[end])
                doc = np.repeat(np.arange(end - start), np.diff(edge[start : end + 1]))
                f = times[part]
                table = np.zeros((sharing.n_terms, end - start), np.int64)
                table[term[part], doc] = weights[term[part]] * ((UNIT * f) // (1000 * f + 8 * mean[start:end][doc]))
                best.add(sharing.scores(table), ids[start:end], no_id[start:end])
        item, score, no_id, doc = best.rows
        docs = pa.array(doc, pa.int64(), mask=no_id.astype(bool))
        yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), docs, pa.array(-score)], ["item", "doc_id", "score"])

    return evaluate


def _searched(docs: DataFrame, ids: list, texts: pa.Array, schema: StructType, top: int) -> DataFrame:
    """(item_id, rank, doc_id, score) for one block of items; ``schema`` names and types (number,
    item_id)."""
    spark = docs.sparkSession
    data, bounds = text_bytes(texts)
    keys, starts, _ = word_keys(data, bounds)
    vocabulary = np.unique(keys)
    number, edge = numbered(keys, vocabulary), np.searchsorted(starts, bounds)
    items = [np.unique(number[a:b]) for a, b in zip(edge[:-1], edge[1:])]
    sharing = Sharing(items, len(vocabulary))
    counted = materialize(term_counts(docs, spark.sparkContext.broadcast(vocabulary)), "term-counts")
    n_docs, all_terms = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # at most a row for each term of the block, whatever the number of documents
    found = dict(map(tuple, counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()))
    plan = spark.sparkContext.broadcast((sharing, term_weights(n_docs, found, len(vocabulary)), n_docs, all_terms))
    near = counted.where(F.size("terms") > 0).mapInArrow(_evaluate(plan, top), "item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = spark.createDataFrame(list(enumerate(ids)), schema)
    return ranked.join(names, F.col("item") == F.col("number")).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """For each row of ``items`` (item_id, text) its ``top`` documents of ``docs`` (doc_id, text) with
    the highest score above 0: item_id, rank (from 1), doc_id, score; equal scores by ascending
    doc_id, a null id last.

    Terms are runs of 0-9, A-Z, a-z and characters beyond ASCII, A-Z as lower case. A null or empty
    text, of either table, has no terms: such a document is not counted and such an item finds
    nothing. Each row is an item or a document of its own, also if its id or all of it repeats. An
    empty table gives an empty result; other columns are not read. Scores are sums of integers and
    do not depend on the order of work. Terms are compared by 64-bit keys.
    """
    schema = StructType([StructField("number", IntegerType()), items.schema["item_id"]])
    blocks = [_searched(docs, ids, texts, schema, top) for ids, texts in item_blocks(items, BLOCK_BYTES)]
    if not blocks:
        empty = StructType([items.schema["item_id"], *[StructField(c, t) for c, t in (("rank", IntegerType()), ("doc_id", LongType()), ("score", LongType()))]])
        return docs.sparkSession.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, blocks)
