"""Near-duplicate vectors by NN-descent (Dong, Moses and Li, 2011).

Only vectors of one label and length can be linked; equal ones are one node. Random hyperplanes
deal the nodes of a label into leaves, several times over, and the nearest neighbours within the
leaves start the graph. Then neighbours meet: all neighbours of a node, in either direction, are
compared with each other and better ones enter the lists, until hardly any does. By the triangle
inequality a neighbour at more than twice the link angle never leads to a link through one step,
so lists hold nearer ones only.

Lists bound who meets whom, never which links count: every leaf and every meeting hands on a
spanning forest of all links it has seen, before any list is cut. A list that is full of links is
saturated and doubles once; if it still is full of links at the end, its links are put into the
components and the search is repeated with lists of their own for neighbours in other components,
until no such list is full of links. So the near copies of a dense group never crowd out the links
that join it to another, and no list grows with a group.

An audit compares a bounded sample of vectors with all rows; while it finds a link between two
components, the graph gets more leaves. Links are then counted exactly within each component, block
by block, so the number of links does not depend on the length of lists.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockroom.llm.components import components
from stockroom.llm.minhash import spanning_links
from stockroom.session import materialize

THRESHOLD = 0.93
#: Neighbours in a list at first, and after a saturated list has doubled; a vector has one list for
#: its own component and one for all others.
NEIGHBOURS, MOST_NEIGHBOURS = 10, 20
#: Vectors in a leaf, and leaves that each vector is in at first.
LEAF, ROUNDS = 256, 12
PLANES = 24
#: The descent ends when this share of list entries at most is new.
SETTLED = 0.02
#: Vectors that the audit compares with all rows.
AUDITED = 400
#: Vectors of a block in the exact count.
BLOCK = 1024

PREPARED = "vec_id long, space string, node binary, vector binary"


def prepare(vectors: DataFrame) -> DataFrame:
    """(vec_id, space, node, vector): ``space`` names label and length, null for vectors that link
    with nothing; ``node`` is the same for equal vectors of a space; ``vector`` has the numbers in the
    precision they came in, 32-bit floats or doubles, behind a byte that says which."""
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    tag, kind = (b"4", np.float32) if single else (b"8", np.float64)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spaces, nodes, found = [], [], []
            for label, values in zip(batch.column("label").to_pylist(), batch.column("embedding").to_pylist()):
                space = node = data = None
                if label is not None and values and None not in values:
                    x = np.array(values, kind) + kind(0)  # -0.0 counts as 0.0
                    if np.isfinite(x).all() and x.any():
                        space, data = f"{label}:{len(x)}", tag + x.tobytes()
                        node = hashlib.md5(space.encode() + b"\0" + data, usedforsecurity=False).digest()
                spaces.append(space)
                nodes.append(node)
                found.append(data)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(spaces, pa.string()), pa.array(nodes, pa.binary()), pa.array(found, pa.binary())], ["vec_id", "space", "node", "vector"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), (F.col("embedding") if single else F.col("embedding").cast("array<double>")).alias("embedding"))
    return rows.mapInArrow(read, PREPARED)


def numbers(vectors: list[bytes]) -> np.ndarray:
    """Vectors of equal length as rows, in the precision they came in."""
    kind = np.float32 if vectors[0][:1] == b"4" else np.float64
    return np.frombuffer(b"".join(v[1:] for v in vectors), kind).reshape(len(vectors), -1)


def unit_rows(vectors: list[bytes]) -> np.ndarray:
    """Vectors of equal length as rows of length 1, in double precision."""
    x = numbers(vectors).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)  # no overflow of the squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


EDGES = "u binary, v binary, cosine double, own boolean, forest boolean"


def _nearest(table: pa.Table, most: int, threshold: float, least_cosine: float) -> pa.Table:
    """``EDGES`` among the rows of ``table`` (node, vector, component): for each node its ``most``
    nearest other ones of its own component, and as many of others, with a cosine of at least
    ``least_cosine``; and a spanning forest of all links between components."""
    nodes, vectors, number = table["node"].to_pylist(), table["vector"].to_pylist(), {}
    component = np.array([number.setdefault(c, len(number)) for c in table["component"].to_pylist()], np.int64)
    out: list[tuple] = []
    x = unit_rows(vectors) if nodes else np.zeros((0, 1))
    linked = np.zeros((len(nodes), len(nodes)), bool)
    for start in range(0, len(nodes), 512):
        cosines = x[start : start + 512] @ x.T
        cosines[np.arange(len(cosines)), np.arange(start, start + len(cosines))] = -2
        own = component[start : start + 512, None] == component
        linked[start : start + 512] = (cosines >= threshold) & ~own
        for is_own, side in ((True, own), (False, ~own)):
            shown = np.where(side, cosines, -2)
            near = (shown >= least_cosine).sum(1)
            for i in np.flatnonzero(near):
                for j in np.argsort(-shown[i], kind="stable")[: min(most, near[i])]:
                    out.append((nodes[start + i], nodes[j], float(shown[i, j]), is_own, False))
    for i, j in spanning_links(linked | linked.T) if linked.any() else []:
        out.append((nodes[i], nodes[j], float(x[i] @ x[j]), False, True))
    u, v, c, own, forest = zip(*out) if out else ((),) * 5
    return pa.table([pa.array(u, pa.binary()), pa.array(v, pa.binary()), pa.array(c, pa.float64()), pa.array(own, pa.bool_()), pa.array(forest, pa.bool_())], ["u", "v", "cosine", "own", "forest"])


def leaf_edges(nodes: DataFrame, first_round: int, rounds: int, threshold: float, least_cosine: float) -> DataFrame:
    """Neighbours and links within leaves of ``nodes`` (node, space, vector, component). A round's leaf is a label's vectors on the same sides of as many
    random hyperplanes as its size asks for; what still is too large is cut by a hash."""

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            codes = []
            for vector in batch.column("vector").to_pylist():
                x = numbers([vector])[0]
                if len(x) not in planes:
                    planes[len(x)] = np.stack([np.random.default_rng([len(x), r]).standard_normal((PLANES, len(x))) for r in range(first_round, first_round + rounds)]).astype(np.float32)
                codes.append(((planes[len(x)] @ x) > 0).astype(np.int64) @ (1 << np.arange(PLANES)))
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("space"), batch.column("vector"), batch.column("component"), pa.array(codes, pa.list_(pa.int64()))], ["node", "space", "vector", "component", "codes"])

    coded = nodes.select("node", "space", "vector", "component").mapInArrow(sides, "node binary, space string, vector binary, component binary, codes array<long>")
    spread = coded.select("node", "space", "vector", "component", F.posexplode("codes").alias("round", "code"))
    sizes = nodes.groupBy("space").agg(F.greatest(F.lit(0), F.least(F.lit(PLANES), F.ceil(F.log2(F.count(F.lit(1)) / LEAF)))).cast("int").alias("bits"))
    cut = spread.join(sizes, "space").withColumn("code", F.expr("code & (shiftleft(1L, bits) - 1)")).drop("bits")
    cut = materialize(cut, "leaf-codes")
    parts = cut.groupBy("round", "space", "code").agg(F.ceil(F.count(F.lit(1)) / (2 * LEAF)).alias("parts"))
    placed = cut.join(parts, ["round", "space", "code"]).withColumn("part", F.pmod(F.xxhash64("node", "round"), F.col("parts")))

    def near(table: pa.Table) -> pa.Table:
        return _nearest(table, NEIGHBOURS, threshold, least_cosine)

    return placed.select("round", "space", "code", "part", "node", "vector", "component").groupBy("round", "space", "code", "part").applyInArrow(near, EDGES)


def _lists(edges: DataFrame, wide: DataFrame | None) -> DataFrame:
    """``edges`` plus k and ``listed``: whether v is one of the ``k`` best neighbours of u in its own
    component or in others; ``wide`` (u) have long lists. Only listed edges and those of a forest."""
    best = Window.partitionBy("u", "own").orderBy(F.desc("cosine"), "v")
    edges = edges.groupBy("u", "v").agg(F.max("cosine").alias("cosine"), F.bool_or("own").alias("own"), F.bool_or("forest").alias("forest"))
    if wide is None:
        edges = edges.withColumn("k", F.lit(NEIGHBOURS))
    else:
        edges = edges.join(wide.withColumn("wide", F.lit(True)), "u", "left").withColumn("k", F.when(F.col("wide"), MOST_NEIGHBOURS).otherwise(NEIGHBOURS)).drop("wide")
    return edges.withColumn("listed", F.row_number().over(best) <= F.col("k")).where("listed or forest")


def _full(lists: DataFrame, threshold: float) -> DataFrame:
    """(u, own, k, full): whether a list is full of links."""
    full = lists.groupBy("u", "own").agg(F.count(F.lit(1)).alias("n"), F.min("cosine").alias("worst"), F.max("k").alias("k"))
    return full.select("u", "own", "k", ((F.col("n") == F.col("k")) & (F.col("worst") >= threshold)).alias("full"))


def descend(nodes: DataFrame, edges: DataFrame, threshold: float, least_cosine: float) -> tuple[DataFrame, DataFrame]:
    """The neighbour graph (u, v, cosine, own, k) that NN-descent reaches from ``edges``, and links
    (a, b) that connect whatever links between components it has seen."""
    lists = materialize(_lists(edges, None), "neighbours")
    vectors = nodes.select(F.col("node").alias("v"), "vector", "component")
    links = lists.where("forest").select(F.col("u").alias("a"), F.col("v").alias("b"))

    def meet(table: pa.Table) -> pa.Table:
        return _nearest(table.rename_columns({"v": "node"}), MOST_NEIGHBOURS, threshold, least_cosine)

    while True:
        lists = lists.where("listed").select("u", "v", "cosine", "own", "k")
        wide = _full(lists, threshold).where((F.col("k") == MOST_NEIGHBOURS) | F.col("full")).select("u").distinct()
        back = lists.select(F.col("v").alias("u"), F.col("u").alias("v"), "cosine", "own", "k")
        nearest = Window.partitionBy("u", "own").orderBy(F.desc("cosine"), "v")
        back = back.withColumn("at", F.row_number().over(nearest)).where("at <= 2 * k").drop("at")
        around = lists.unionByName(back).select("u", "v").distinct()
        met = around.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("u"))).where("n > 1").select("u", "v").join(vectors, "v")
        found = met.groupBy("u").applyInArrow(meet, EDGES)
        known = lists.select("u", "v", F.lit(True).alias("old"))
        merged = _lists(lists.select("u", "v", "cosine", "own", F.lit(False).alias("forest")).unionByName(found), wide)
        lists = materialize(merged.join(known, ["u", "v"], "left").withColumn("new", F.col("old").isNull()).drop("old"), "neighbours")
        links = links.unionByName(lists.where("forest").select(F.col("u").alias("a"), F.col("v").alias("b")))
        fresh, total = lists.where("listed").agg(F.coalesce(F.sum(F.col("new").cast("long")), F.lit(0)), F.count(F.lit(1))).first()
        if fresh <= SETTLED * total:
            return lists.where("listed").select("u", "v", "cosine", "own", "k"), links


def missed_links(nodes: DataFrame, groups: DataFrame, threshold: float, audited: int = AUDITED) -> tuple[int, int]:
    """The audit: (links of a sample of nodes to all others, those between two components). The
    sample is the ``audited`` first nodes by a hash; its vectors go to all tasks, which compare
    their rows with it in blocks and return one row for each link's end."""
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(audited).join(groups, "node", "left").select("node", "space", "vector", F.coalesce("component", "node").alias("component")).collect()
    asked: dict[str, tuple] = {}
    for space in {r["space"] for r in sample}:
        own = [r for r in sample if r["space"] == space]
        asked[space] = [bytes(r["node"]) for r in own], unit_rows([bytes(r["vector"]) for r in own]), [bytes(r["component"]) for r in own]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = missed = 0
            by: dict[str, list[tuple]] = {}
            for row in zip(*(batch.column(c).to_pylist() for c in ("space", "node", "vector", "component"))):
                if row[0] in asked:
                    by.setdefault(row[0], []).append(row[1:])
            for space, rows in by.items():
                names, x, own = asked[space]
                for i, j in zip(*np.nonzero(x @ unit_rows([r[1] for r in rows]).T >= threshold)):
                    if names[i] != rows[j][0]:
                        links += 1
                        missed += own[i] != rows[j][2]
            yield pa.RecordBatch.from_arrays([pa.array([links], pa.int64()), pa.array([missed], pa.int64())], ["links", "missed"])

    rows = nodes.join(groups, "node", "left").select("space", "node", "vector", F.coalesce("component", "node").alias("component"))
    found = rows.mapInArrow(compare, "links long, missed long").agg(F.coalesce(F.sum("links"), F.lit(0)), F.coalesce(F.sum("missed"), F.lit(0))).first()
    return tuple(found)


def link_counts(nodes: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """(node, links): how many vectors other than the node's own copies have a cosine of at least
    ``threshold`` with it, over all pairs of its component. Components are cut into hashed blocks
    and each two blocks meet in a task of their own."""
    members = nodes.join(groups, "node")
    blocks = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    placed = members.join(blocks, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    units = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = units.select("node", "vector", "copies", "component", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))

    def count(table: pa.Table) -> pa.Table:
        nodes, copies, block = table["node"].to_pylist(), table["copies"].to_numpy(), table["block"].to_numpy()
        x = unit_rows(table["vector"].to_pylist())
        one, two = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
        same, links = block.min() == block.max(), np.zeros(len(nodes), np.int64)
        if same and table["i"][0].as_py() != table["j"][0].as_py():
            return pa.table([pa.array([], pa.binary()), pa.array([], pa.int64())], ["node", "links"])  # the other block is empty
        near = x[one] @ x[two].T >= threshold
        if same:
            np.fill_diagonal(near, False)
        links[one] += near @ copies[two]
        if not same:
            links[two] += near.T @ copies[one]
        return pa.table([pa.array(nodes, pa.binary()), pa.array(links)], ["node", "links"])

    found = units.groupBy("component", "i", "j").applyInArrow(count, "node binary, links long")
    return found.groupBy("node").agg(F.sum("links").alias("links"))


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Two rows are linked if their labels are equal and not null, their vectors have the same length
    and their cosine in double precision is at least ``threshold``. Vectors that are null, empty,
    zero or hold null or non-finite components link with nothing, nor do rows with a null label.
    Equal vectors are linked, repeated rows too; a hot vector is one node. A null id is the
    component of no one unless all ids of the component are null. An empty table gives an empty
    result; other columns are not read.
    """
    rows = materialize(prepare(vectors), "vectors")
    nodes = rows.where("node is not null").groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.min("space").alias("space"), F.min("vector").alias("vector"))
    nodes = materialize(nodes, "vector-nodes")
    least_cosine = math.cos(min(2 * math.acos(threshold), math.pi))
    edges, groups, done = None, None, 0
    while True:
        if groups is None:
            placed = nodes.withColumn("component", F.col("node"))
        else:
            placed = materialize(nodes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node")), "vector-nodes")
        more = leaf_edges(placed, done, rounds, threshold, least_cosine)
        if edges is not None:
            ends = [placed.select(F.col("node").alias(end), F.col("component").alias(f"_{end}")) for end in ("u", "v")]
            old = edges.join(ends[0], "u").join(ends[1], "v").select("u", "v", "cosine", (F.col("_u") == F.col("_v")).alias("own"), F.lit(False).alias("forest"))
            more = more.unionByName(old)
        edges, links = descend(placed, more, threshold, least_cosine)
        done += rounds
        if groups is not None:
            links = links.unionByName(groups.select(F.col("node").alias("a"), F.col("component").alias("b")))
        groups = materialize(components(links), "vector-groups")
        # links that filled a list of other components have joined some of them: there are fewer now
        crowded = _full(edges.where("not own"), threshold).where("full").limit(1).count()
        if not crowded and missed_links(nodes, groups, threshold)[1] == 0:
            break
    counts = link_counts(nodes.select("node", "vector", "copies"), groups, threshold)
    known = nodes.select("node", "copies").join(groups, "node", "left").join(counts, "node", "left")
    known = known.select("node", F.coalesce("component", "node").alias("component"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    placed = rows.select("vec_id", "node").join(known, "node", "left")
    filled = placed.where("component is not null")
    smallest = filled.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    found = filled.join(smallest, "component").select("vec_id", "n_links", "component_id")
    alone = placed.where("component is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
