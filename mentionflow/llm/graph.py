"""Connected components of an undirected graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) of all nodes of ``edges`` (``a``, ``b``).

    Every round each node takes the neighbour, or itself, that comes first in an order drawn
    anew, and the graph shrinks to the nodes taken: an edge goes on between what its two ends
    took, once, however many edges there were. In a random order a fixed share of the nodes
    leaves each round, so rounds are few and the last ones tiny; that an end took a neighbour
    keeps what was connected connected. Each round is written, which cuts the lineage.

    Nodes with many edges meet sums per node and joins against one row per node, which can be
    split. NULL ends and loops are left out; an empty frame gives no rows.
    """
    left = materialize(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct(), "edges")
    taken, turn = None, 0
    while True:
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = lambda n: F.struct(F.xxhash64(n, F.lit(turn)).alias("draw"), F.col(n).alias("id"))  # noqa: B023, E731
        took = both.groupBy("a").agg(F.min(first("b")).alias("best")).select(F.col("a").alias("node"), F.least("best", first("a"))["id"].alias("into"))
        took = materialize(took, "taken")
        step = took.select(F.col("node").alias("at"), F.col("into").alias("next"))
        taken = took if taken is None else materialize(
            taken.join(step, F.col("into") == F.col("at"), "left").select("node", F.coalesce("next", "into").alias("into")), "taken")
        ends = [step.select(F.col("at").alias(f"at_{c}"), F.col("next").alias(f"next_{c}")) for c in "ab"]
        shrunk = left.join(ends[0], F.col("a") == F.col("at_a")).join(ends[1], F.col("b") == F.col("at_b"))
        pair = [F.least("next_a", "next_b").alias("a"), F.greatest("next_a", "next_b").alias("b")]
        left = materialize(shrunk.where(F.col("next_a") != F.col("next_b")).select(*pair).distinct(), "edges")
        if left.isEmpty():
            names = taken.groupBy("into").agg(F.min("node").alias("component")).select(F.col("into").alias("name"), "component")
            return taken.join(names, F.col("into") == F.col("name")).select("node", "component")
        turn += 1
