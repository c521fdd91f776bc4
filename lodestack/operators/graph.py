"""Edges (src, dst): degrees, second-degree links, reachability."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import stored


def degrees(edges: DataFrame, node: str, other: str) -> DataFrame:
    """Distinct neighbours of each node (AGG-17)."""
    return edges.groupBy(node).agg(F.count_distinct(other).alias("degree"))


def second_degree(edges: DataFrame) -> DataFrame:
    """Pairs two steps apart that aren't linked directly nor equal (JOIN-19)."""
    e = edges.select("src", "dst").distinct()
    two = e.join(e.select(F.col("src").alias("dst"), F.col("dst").alias("far")), "dst").where("src != far").select("src", F.col("far").alias("dst")).distinct()
    return two.join(e, ["src", "dst"], "left_anti")


def reachable(edges: DataFrame, steps: int | None = None) -> DataFrame:
    """(src, dst) within ``steps`` steps, or at any distance, once each (UDF-3).

    Paths are doubled: pairs within n steps joined with themselves give those
    within 2n.  Each round is a stored table, so no plan grows; without a number
    of steps rounds end when a pair more isn't found.
    """
    within, far, left, label = stored(edges.select("src", "dst").distinct(), "paths"), None, steps, "paths"
    found = within.count() if steps is None else 0
    while left is None or left:
        if left is not None and left & 1:
            far = within if far is None else stored(_joined(far, within), label)
        left = left >> 1 if left is not None else None
        if left != 0:
            longer = stored(_joined(within, within), label)
            if left is None:
                before, found = found, longer.count()
                if found == before:
                    return longer
            within = longer
    return far if far is not None else within.limit(0)


def _joined(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs of a, of b, and of a followed by b."""
    step = a.join(b.select(F.col("src").alias("dst"), F.col("dst").alias("_n")), "dst").select("src", F.col("_n").alias("dst"))
    return a.unionByName(b).unionByName(step).distinct()


def downstream(nodes: DataFrame, edges: DataFrame, steps: int = 4) -> DataFrame:
    """How many other nodes each node reaches (AGG-18)."""
    far = reachable(edges, steps).where("src != dst").groupBy("src").agg(F.count("*").alias("n"))
    return nodes.select(F.col(nodes.columns[0]).alias("node")).join(far.withColumnRenamed("src", "node"), "node", "left").select("node", F.coalesce("n", F.lit(0)).alias("downstream"))


def on_cycle(edges: DataFrame) -> DataFrame:
    """Nodes that reach themselves: feedback loops of any length (UDF-3).  Nodes that nothing leads to are left out first."""
    e = edges.select("src", "dst").distinct()
    inner = e.join(e.select(F.col("dst").alias("src")).distinct(), "src", "left_semi")
    return reachable(inner).where("src = dst").select(F.col("src").alias("node"))
