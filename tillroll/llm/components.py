"""Connected components of a graph given as edges.

Edges are turned into stars round by round (large star, small star). Every round works on
edges only, writes its result to the shared folder and ends when nothing changed; the
number of rounds grows with the logarithm of the longest path. A node with very many
edges meets its own minimum in a plain join of two stored tables, which Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.scratch import materialize


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is its smallest node.

    Nodes must not be null. Loops and repeated edges are allowed; without any edge the
    result is empty.
    """
    pairs = materialize(
        edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .where("hi != lo")
        .distinct(),
        "component_edges",
    )
    before = _mark(pairs)
    while before[0]:
        ends = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        both = ends.union(pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = materialize(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "component_low")
        large = materialize(
            both.where("v > u")
            .join(low, "u")
            .select(F.col("v").alias("hi"), F.col("m").alias("lo"))
            .where("hi != lo")
            .distinct(),
            "component_large",
        )
        low = materialize(large.groupBy("hi").agg(F.min("lo").alias("m")), "component_low")
        moved = large.join(low, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        pairs = materialize(
            moved.union(low.select("hi", F.col("m").alias("lo"))).distinct(), "component_edges"
        )
        after = _mark(pairs)
        if after == before:
            break
        before = after
    roots = pairs.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(roots)
