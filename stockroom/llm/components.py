"""Connected components of an undirected graph by alternating star contraction (Kiveris et al., 2014).

Every round hangs the larger neighbours of each node on its smallest one, then does the same for
the smaller neighbours, until only stars are left; long chains take a logarithmic number of rounds.
A round is joins and grouped minima of edges, written once to the shared folder. The driver sees a
count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.session import materialize


def _smallest(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) plus ``m``, the smallest v of the same u or u itself."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("_u", "m").alias("m"))
    return edges.join(least, F.col("u") == F.col("_u")).drop("_u")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node that can be reached.
    Nodes are of any type that can be ordered; edges with a null end and loops are left out."""
    now = edges.where("a is not null and b is not null and a <> b")
    now = now.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, before = materialize(now, "edges"), None
    while True:
        mark = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if mark == before or mark[0] == 0:
            break
        before = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _smallest(large)
        ends = F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
        now = materialize(small.select(ends.alias("e")).select("e.u", "e.v").where("u <> v").distinct(), "edges")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(roots)
