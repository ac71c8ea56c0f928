"""Connected components of a graph in a table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of longs -> (node, component): the smallest node of each component, for every node with an edge.

    Each round points every node at its smallest neighbour, follows pointers twice, and contracts the edges onto
    what the pointers lead to; a path of n nodes takes about log4(n) rounds. Each round's tables are written to the
    shared folder, so a lost executor costs no earlier round. Nothing but "are edges left" reaches the driver.
    Self-loops and repeated edges are allowed; an empty table gives an empty result.
    """
    left = written(edges.where("a <> b").select("a", "b"), "edges")
    maps: list[DataFrame] = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("to"))
        points = written(near, "pointers")
        for _ in range(2):
            points = _follow(points, points)
        points = written(points, "pointers")
        maps.append(points)
        a = points.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        b = points.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        moved = left.join(a, "a").join(b, "b").where("to_a <> to_b")
        left = written(moved.select(F.greatest("to_a", "to_b").alias("a"), F.least("to_a", "to_b").alias("b")).distinct(), "edges")
    if not maps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = maps[0]
    for later in maps[1:]:
        found = _follow(found, later)
    return found.select("node", F.col("to").alias("component"))


def _follow(points: DataFrame, onward: DataFrame) -> DataFrame:
    """Pointers replaced by where ``onward`` leads from their ends."""
    ends = onward.select(F.col("node").alias("to"), F.col("to").alias("further"))
    return points.join(ends, "to", "left").select("node", F.coalesce("further", "to").alias("to"))
