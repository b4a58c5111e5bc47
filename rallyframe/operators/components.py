"""Connected components of an edge list."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rallyframe.workspace import materialise


def _pulled(edges: DataFrame, upper: Column) -> DataFrame:
    """Every node ties those neighbours for which ``upper`` holds to the least node it knows."""
    ways = edges.union(edges.select("far", "near")).toDF("near", "far")
    least = ways.groupBy("near").agg(F.min("far").alias("m")).select("near", F.least("near", "m").alias("m"))
    tied = ways.where(upper).join(least, "near")
    return tied.select(F.col("far").alias("near"), F.col("m").alias("far")).union(least.select("near", F.col("m").alias("far")))


def components(edges: DataFrame, first: str, second: str) -> DataFrame:
    """(node, root) for every node of an edge list but the roots; a root is the least node of its component.

    In turns every node ties its greater and then its smaller neighbours to the least node around it, so paths
    halve; a round is one written table, and the rounds end when nothing moves.
    """
    now = materialise(edges.select(F.col(first).alias("near"), F.col(second).alias("far")).where("near <> far").distinct(), "edges")
    before = None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("near", "far").cast("decimal(38,0)")).alias("s")).first()
        if seen == before or not seen["n"]:
            return now.select(F.col("near").alias("node"), F.col("far").alias("root"))
        before = seen
        large = _pulled(now, F.col("far") > F.col("near")).where("near <> far").distinct()
        now = materialise(_pulled(large, F.col("far") < F.col("near")).where("near <> far").distinct(), "edges")


def components_within(edges: DataFrame, group: str, first: str, second: str) -> DataFrame:
    """(node, root) for every node (a long) of groups of bounded size; the least node of its component is the root.

    A group is one task and one shuffle of its edges, where ``components`` writes a table per round. Nodes of different groups differ.
    """
    def roots(part: pa.Table) -> pa.Table:
        nodes, at = np.unique(np.concatenate([part.column(c).to_numpy() for c in ("x", "y")]), return_inverse=True)
        x, y = at[:part.num_rows], at[part.num_rows:]
        low = np.arange(len(nodes))
        while (open_ := low[x] != low[y]).any():
            x, y = low[x[open_]], low[y[open_]]  # roots that an edge still ties
            np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
            while (further := low[low] != low).any():
                low[further] = low[low[further]]
        return pa.table({"node": nodes, "root": nodes[low]})

    pairs = edges.select(group, F.col(first).alias("x"), F.col(second).alias("y")).where("x <> y").distinct()
    return pairs.groupBy(group).applyInArrow(roots, "node long, root long")
