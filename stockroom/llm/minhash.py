"""Near-duplicate documents by bottom-k sketches.

1. One pass hashes the word shingles of every text with one hash function. The smallest ``K`` hashes
   of a text are its sketch; a digest of all of them stands for its set. Texts with equal sets are
   one node from here on, so exact copies never meet each other.
2. Sketch values that several nodes retain form inverted lists. Two sets with the wanted similarity
   share at least half of ``K`` values but for one pair in a million at the very limit, so only the
   rarest half of a node's values (and one more) need lists: a line that many texts hold drops out.
3. Nodes of a list hang on the list's smallest node. The connected families of these edges hold all
   candidates; there is a row for each list entry, never for each pair.
4. A family's texts, cut into blocks if they are many, meet in tasks block by block. A task
   estimates each pair's similarity from the union of the two sketches, settles what passes on the
   full sets and returns a spanning forest of its links.
5. The components of all links are the groups of near duplicates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockroom.llm.arrowtext import text_chunks
from stockroom.llm.components import components
from stockroom.llm.names import plain_names
from stockroom.llm.quality import WordIds
from stockroom.session import materialize

WIDTH = 5
PERCENT = 75
#: Retained values of a sketch.
K = 64
#: Values that two sketches share at least if their sets are linked. Of the K smallest values of a
#: union each is shared with probability 0.75, so fewer than 32 of 64 are with probability 1e-6.
SHARED = 32
#: Estimates below this share of the union sketch are not settled on full sets (5 standard errors).
ESTIMATE = 0.48
#: Bytes of text of a block of a family; a task has two blocks.
BLOCK_BYTES = 3 << 20
BLOCK_ROWS = 512

SKETCHES = "doc_id long, digest binary, n_shingles long, node binary, n_bytes long, sketch array<long>"
HAS_WORD = "[^\\x20\\x09-\\x0D]"


def shingle_set(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of a sequence of word ids; the
    whole sequence is one shingle if it is shorter."""
    n = max(len(words) - width + 1, min(len(words), 1))
    keys = np.full(n, np.uint64(min(len(words), width)), np.uint64)
    for i in range(min(width, len(words))):
        keys = (keys ^ (keys >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        keys = (keys ^ (keys >> np.uint64(shift))) * np.uint64(factor)
    return np.unique(keys ^ (keys >> np.uint64(31)))


def set_key(hashes: np.ndarray) -> bytes:
    return hashlib.md5(hashes.tobytes(), usedforsecurity=False).digest()


def _set_of(text: str | None, ids: WordIds) -> tuple[np.ndarray, int]:
    data = (text or "").encode()
    return shingle_set(ids(data.lower().split())), len(data)  # bytes.lower folds A-Z alone


def sketches(docs: DataFrame) -> DataFrame:
    """``SKETCHES`` for each row of ``docs`` (doc_id, text); ``node`` is null for an empty set,
    ``digest`` is the MD5 of the text."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds()
        for batch in text_chunks(batches):
            texts = batch.column("text").to_pylist()
            sets = [_set_of(t, ids) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([hashlib.md5((t or "").encode(), usedforsecurity=False).digest() for t in texts], pa.binary()),
                    pa.array([len(s) for s, _ in sets], pa.int64()),
                    pa.array([set_key(s) if len(s) else None for s, _ in sets], pa.binary()),
                    pa.array([n for _, n in sets], pa.int64()),
                    pa.array([s[:K].view(np.int64) for s, _ in sets], pa.list_(pa.int64())),
                ],
                ["doc_id", "digest", "n_shingles", "node", "n_bytes", "sketch"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(sketch, SKETCHES)


def candidate_edges(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) of candidate families of ``nodes`` (node, sketch): each node of an inverted list
    with the list's smallest node. A list is grouped and joined by its value; both sides have one
    row per entry, and the adaptive skew join splits a list that a third of all nodes are in."""
    values = nodes.select("node", F.size("sketch").alias("kept"), F.explode("sketch").alias("value"))
    lists = values.groupBy("value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    entries = materialize(values.join(lists, "value"), "list-entries")
    # a node's retained values by rarity: those in no list are the rarest
    rare = Window.partitionBy("node").orderBy("n", "value")
    ranked = entries.withColumn("at", F.row_number().over(rare)).withColumn("listed", F.count(F.lit(1)).over(Window.partitionBy("node")))
    need = F.ceil(F.col("kept") * (SHARED / K))
    used = ranked.where((F.col("kept") - F.col("listed") + F.col("at")) <= F.col("kept") - need + 1).select("node", "value")
    heads = used.groupBy("value").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return used.join(heads, "value").where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b"))


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of sorted sets, in column slices of bounded size."""
    n, lengths = len(sets), [len(s) for s in sets]
    values, owner = np.concatenate(sets), np.repeat(np.arange(n), lengths)
    _, column, times = np.unique(values, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    column, owner = column[shared], owner[shared]
    out = np.zeros((n, n), np.float32)
    if len(column):
        _, column = np.unique(column, return_inverse=True)
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        width = min(int(column[-1]) + 1, max(64, (4 << 20) // n))
        for start in range(0, int(column[-1]) + 1, width):
            lo, hi = np.searchsorted(column, [start, start + width])
            part = np.zeros((n, width), np.float32)
            part[owner[lo:hi], column[lo:hi] - start] = 1
            out += part @ part.T  # counts below 2 ** 24 are exact
    return out


def similar(sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """Which pairs of non-empty sorted sets have a Jaccard similarity of at least ``percent``. The
    share of a union sketch that lies in both sets estimates it, and is at most the number of values
    that the two sketches share over the union sketch's size; pairs for which that is below
    ``ESTIMATE`` are ruled out, all others are settled on the full sets."""
    n = len(sets)
    tops = [s[:K] for s in sets]
    common, kept = _overlaps(tops), np.array([len(t) for t in tops])
    open_pairs = common >= np.floor(ESTIMATE * np.minimum(K, np.maximum(kept[:, None], kept[None, :])))
    np.fill_diagonal(open_pairs, False)
    live = np.flatnonzero(open_pairs.any(1))
    linked = np.zeros((n, n), bool)
    if len(live):
        both = _overlaps([sets[i] for i in live]).astype(np.int64)
        size = np.array([len(sets[i]) for i in live], np.int64)
        union = size[:, None] + size[None, :] - both
        linked[np.ix_(live, live)] = (100 * both >= percent * union) & open_pairs[np.ix_(live, live)]
    return linked


def spanning_links(linked: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a symmetric matrix of links."""
    out, fresh = [], np.ones(len(linked), bool)
    for root in range(len(linked)):
        if not fresh[root]:
            continue
        fresh[root], todo = False, [root]
        while todo:
            i = todo.pop()
            found = np.flatnonzero(linked[i] & fresh)
            fresh[found] = False
            out.extend((i, int(j)) for j in found)
            todo.extend(found.tolist())
    return out


def texts_of(docs: DataFrame, members: DataFrame) -> DataFrame:
    """``members`` (node, doc_id, digest, n and others) with the text of each node, one row per node:
    that of the row of ``docs`` with the node's doc_id and digest, of which ``docs`` has ``n``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.unhex(F.md5("text")).alias("_digest"), "text").where("text is not null")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    # members grow with the texts, so they are not to be broadcast at any size
    said = members.where("n = 1").hint("merge").join(texts, same).drop("_id", "_digest")
    several = members.where("n > 1")
    if several.limit(1).count():
        # equal rows become one before the shuffle, however often a row is repeated
        columns = members.columns
        found = several.hint("merge").join(texts.groupBy("_id", "_digest").agg(F.any_value("text").alias("text")), same)
        said = said.unionByName(found.select(*columns, "text"))
    return said


def verified_links(docs: DataFrame, members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) that connect all linked nodes of each family. ``members``: node, doc_id, digest, n,
    n_bytes, family. A family of many texts is cut into hashed blocks, and every two blocks of it meet."""
    sizes = members.groupBy("family").agg(F.greatest(F.ceil(F.sum("n_bytes") / BLOCK_BYTES), F.ceil(F.count(F.lit(1)) / BLOCK_ROWS)).cast("int").alias("blocks"))
    placed = members.join(sizes, "family").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    said = texts_of(docs, placed)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    units = said.select("node", "text", "family", "block", "blocks", other.alias("other"))
    units = units.where("blocks = 1 or block <> other")  # two blocks' task also has the pairs within each
    units = units.select("node", "text", "family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))

    def settle(table: pa.Table) -> pa.Table:
        ids, sets = WordIds(), {}
        for node, text in zip(table["node"].to_pylist(), table["text"].to_pylist()):
            hashes, _ = _set_of(text, ids)
            sets[node] = hashes
        names = list(sets)
        links = spanning_links(similar(list(sets.values()), percent)) if len(names) > 1 else []
        return pa.table([pa.array([names[i] for i, _ in links], pa.binary()), pa.array([names[j] for _, j in links], pa.binary())], ["a", "b"])

    return units.groupBy("family", "i", "j").applyInArrow(settle, "a binary, b binary")


def _grouped(docs: DataFrame, percent: int) -> DataFrame:
    """(doc_id, digest, n_shingles, component) for each row; ``component`` is null for an empty set."""
    docs = docs.select("doc_id", "text")
    rows = materialize(sketches(docs), "sketches")
    nodes = rows.where("node is not null").groupBy("node").agg(F.any_value("sketch").alias("sketch"))
    families = components(candidate_edges(nodes.select("node", "sketch")))
    # a node's text is read from one row: preferably one that is not repeated
    equal = rows.where("node is not null").groupBy("node", "doc_id", "digest").agg(F.count(F.lit(1)).alias("n"), F.max("n_bytes").alias("n_bytes"))
    members = equal.groupBy("node").agg(F.min(F.struct("n", "doc_id", "digest", "n_bytes")).alias("row")).select("node", "row.*")
    members = materialize(members.join(families.withColumnRenamed("component", "family"), "node"), "families")
    groups = components(verified_links(docs, members, percent))
    joined = rows.select("doc_id", "digest", "n_shingles", "node").join(groups, "node", "left")
    return joined.select("doc_id", "digest", "n_shingles", F.coalesce("component", "node").alias("component"))


def near_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Rows are linked if the Jaccard similarity of their sets of five-word shingles is at least
    ``percent`` hundredths; ``component_id`` is the smallest doc_id that links reach. A null text,
    an empty one and one without words have an empty set and are linked with nothing. Texts of
    fewer than five words have one shingle. Rows with equal ids are told apart by their text but
    share what their id means for ``kept``. A null id never is a component id unless all ids of
    the group are null; such rows are kept if they are alone. An empty table gives an empty
    result; other columns are not read. Sets are compared by 64-bit hashes of their shingles.
    """
    joined = _grouped(docs, percent)
    filled = joined.where("component is not null")
    smallest = filled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    found = filled.join(smallest, "component").select("doc_id", "n_shingles", "component_id")
    alone = joined.where("component is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_first(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each group of near duplicates one
    row, that with the smallest doc_id (null last), then the smallest MD5 of the text, then, among
    rows with equal id and text, the smallest other columns. Texts without words, null ones among
    them, all stay. An empty table gives an empty result."""
    names, docs = docs.columns, plain_names(docs, "doc_id", "text")
    grouped = _grouped(docs, percent).where("component is not null")
    copies = grouped.groupBy("component", "doc_id", "digest").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest", "n")).alias("first")
    kept = copies.groupBy("component").agg(first).select(F.col("first.doc_id").alias("_id"), F.col("first.digest").alias("_digest"), F.col("first.n").alias("_n"))
    kept = materialize(kept, "kept")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("_id")) & (F.unhex(F.md5(docs["text"])) == F.col("_digest"))
    out = docs.where(~F.coalesce(docs["text"].rlike(HAS_WORD), F.lit(False))).unionByName(docs.join(kept.where("_n = 1"), same, "left_semi"))
    several = kept.where("_n > 1")
    if several.limit(1).count():
        # a grouped minimum is partly found before the shuffle, however often a row is repeated
        rows = docs.join(several, same).groupBy("_id", "_digest").agg(F.min(F.struct(*[docs[c] for c in docs.columns])).alias("_row"))
        out = out.unionByName(rows.select("_row.*"))
    return out.toDF(*names)
