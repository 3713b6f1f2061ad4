"""Distributed connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logharbor.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of the edges ``(a, b)``; a component's id is its smallest node.

    Each round sends every node to the neighbour (or itself) that comes first in a fixed hash order and
    renames the edges' ends accordingly; edges that became loops go. A hash order makes the expected number
    of rounds logarithmic also for long chains, and a star takes two. Rounds are written to the shared
    folder, so a lost executor costs one round; the driver sees only whether edges are left.

    Edges with a null end, loops and repeated edges are allowed and change nothing. No edges: no rows.
    """
    edges = materialize(
        edges.select("a", "b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(), "edges")
    steps = []
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy(F.col("a").alias("node")).agg(
            F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("to"))).alias("near")
        ).select("node", F.least(F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("to")), "near")["to"].alias("to"))
        step = materialize(step, "components")
        ends = (
            edges.join(step.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        )
        edges = materialize(
            ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        steps.append(step)
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = steps[0]
    for step in steps[1:]:
        onward = step.select(F.col("node").alias("to"), F.col("to").alias("next"))
        labels = labels.join(onward, "to", "left").select("node", F.coalesce("next", "to").alias("to"))
    labels = materialize(labels, "components")
    least = labels.groupBy("to").agg(F.min("node").alias("component"))
    return labels.join(least, "to").select("node", "component")
