"""Connected components of an edge table by contraction.

Each round points every node to its smallest neighbour if that is smaller,
follows the pointers to their ends by doubling, and rewrites the edges by them;
edges inside a contracted group vanish, and only nodes smaller than all their
neighbours are left. Rounds end when no edge is left. Groups are only aggregated (with map-side combine), so a node of
any degree is reduced before the shuffle; only row counts reach the driver.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import gathered, stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component is named by its smallest node.

    Self-loops, repeated edges and both directions are allowed; edges with a
    null end are ignored. No edges give no rows.
    """
    both = edges.where("a is not null and b is not null")
    first = stored(both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    left = first.count()
    nodes, smallest = 2 * left, _smallest(first, left)
    labels = smallest.select("node", F.col("node").alias("component"))
    rest = first.where("a != b")
    while left:
        parents = _roots(smallest.where("parent < node"), left)
        named = labels.join(parents.withColumnRenamed("node", "component"), "component", "left") \
            .select("node", F.coalesce("parent", "component").alias("component"))
        labels = stored(gathered(named, nodes), "labels")
        moved = rest.join(parents.select(F.col("node").alias("a"), F.col("parent").alias("pa")), "a", "left") \
            .join(parents.select(F.col("node").alias("b"), F.col("parent").alias("pb")), "b", "left") \
            .select(F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b")).where("a != b")
        rest = stored(gathered(moved.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), left), "edges")
        left = rest.count()
        if left:
            smallest = _smallest(rest, left)
    return labels


def _smallest(edges: DataFrame, n: int) -> DataFrame:
    """(node, parent): the smallest neighbour of every node of ``n`` edges (a, b)."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("n"), F.col("b").alias("m")),
                                          F.struct(F.col("b").alias("n"), F.col("a").alias("m")))).alias("e"))
    return stored(gathered(ends.groupBy(F.col("e.n").alias("node")).agg(F.min("e.m").alias("parent")), 2 * n), "parents")


def _roots(parents: DataFrame, n: int) -> DataFrame:
    """Each node's last ancestor, by pointer doubling (parents of ``n`` edges, smaller than their children)."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        jumped = stored(gathered(parents.join(up, "parent", "left"), 2 * n), "jumped")
        if jumped.where("above is not null").isEmpty():
            return parents
        parents = jumped.select("node", F.coalesce("above", "parent").alias("parent"))
