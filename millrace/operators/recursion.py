"""Recursion over tables: reachability by semi-naive rounds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch


def reachable(edges: DataFrame, start: DataFrame, scratch: Scratch | None = None, most: int | None = None) -> DataFrame:
    """(node, depth) of what can be reached from the nodes of start (node) along edges (src, dst), at least steps.

    Each round joins only the frontier, the nodes that the round before found, with
    the edges, and drops what is known; frontiers are written, so lineage stays
    short and a lost executor costs one round. One number a round reaches the
    driver. Edges are plain shuffled, so Spark splits a hub's. Repeated edges and
    loops change nothing, null ends are no edges, a null start is left out; `most`
    bounds the steps.
    """
    scratch = scratch or Scratch(edges.sparkSession, "reachable")
    edges = scratch.cut(edges.select("src", "dst").filter("src is not null and dst is not null and src <> dst").distinct(), "edges")
    levels = [scratch.cut(start.select("node").filter("node is not null").distinct().withColumn("depth", F.lit(0)), "frontier")]
    while not levels[-1].isEmpty() and (most is None or len(levels) <= most):
        known = reduce(DataFrame.unionAll, levels).select("node")
        new = levels[-1].join(edges, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct().join(known, "node", "left_anti")
        levels.append(scratch.cut(new.withColumn("depth", F.lit(len(levels))), "frontier"))
    return reduce(DataFrame.unionAll, levels)
