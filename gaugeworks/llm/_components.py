"""Connected components by contraction, with all state in written tables.

Each round points every node at its smallest neighbour, shortens the pointers,
relabels the edges by them and drops those that became loops.  A component that
still has edges at least halves its nodes in a round, so rounds grow with the
logarithm of the largest component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ._store import Workspace


def components(spark: SparkSession, edges: DataFrame, ws: Workspace) -> DataFrame:
    """(node, component) for every node with an edge; the component is its smallest node.

    ``edges`` has a and b; loops, repeats and nulls are ignored.
    """
    once = lambda df: df.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()  # noqa: E731  an edge is one row
    left = ws.put(once(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))), "edges-0")
    labels, round_no = None, 0
    while not left.isEmpty():
        both = left.select("a", "b").union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = ws.put(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("to")), f"step-{round_no}")
        for jump in range(2):
            up = step.select(F.col("node").alias("to"), F.col("to").alias("up"))
            step = ws.put(step.join(up, "to").select("node", F.col("up").alias("to")), f"jump-{round_no}-{jump}")
        if labels is None:
            labels = step.select("node", F.col("to").alias("component"))
        else:
            moved = step.select(F.col("node").alias("component"), "to")
            labels = ws.put(labels.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component")), f"labels-{round_no}")
        by_a = step.select(F.col("node").alias("a"), F.col("to").alias("new_a"))
        by_b = step.select(F.col("node").alias("b"), F.col("to").alias("new_b"))
        half = ws.put(left.join(by_a, "a").select(F.col("new_a").alias("a"), "b").distinct(), f"half-{round_no}")
        round_no += 1
        left = ws.put(once(half.join(by_b, "b").select("a", F.col("new_b").alias("b"))), f"edges-{round_no}")
    return spark.createDataFrame([], "node long, component long") if labels is None else labels
