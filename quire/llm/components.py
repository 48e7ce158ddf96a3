"""Connected components of a table of links, by alternating large and small stars.

Each round reads the links of the round before from a written table, so lineage stays short and a
lost executor costs one round. Rounds grow with the logarithm of the longest chain. Nothing is
collected but two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import Scratch


def _star(edges: DataFrame, large: bool, scratch: Scratch) -> DataFrame:
    """Edges (u, v) with u > v; links every neighbour (large: greater, small: smaller) to the least one.

    The least neighbours are written before they are joined, so that a hot node is split.
    """
    near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = near.groupBy("u").agg(F.min("v").alias("m"))
    least = scratch.keep(least.select("u", F.least("u", "m").alias("m")) if large else least, "least")
    if large:
        return scratch.keep(near.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return scratch.keep(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b); component is its least node.

    Null ends and loops are left out. The result is a written table.
    """
    edges = links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = scratch.keep(edges, "edges")
    state = None
    while True:
        middle = _star(edges, True, scratch)
        nxt = _star(middle, False, scratch)
        scratch.drop(edges, middle)
        edges = nxt
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    out = scratch.keep(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots), "components")
    scratch.drop(edges)
    return out
