"""Connected components by randomised contraction, all in joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialise


def components(edges: DataFrame) -> DataFrame:
    """Nodes of the edges (a long, b long) with ``root``, one node of their component.

    Each round every node takes its neighbour of lowest hash, or itself, as
    parent; the edges and earlier roots move to the parents. A chain of
    parents has falling hashes, so there are no cycles, and the expected
    number of nodes with edges falls by a constant factor each round. Rounds
    are written to the shared folder, so lost executors cost one round only.
    Minima are combined before each shuffle; only single-row sides meet a hub
    in the joins, which adaptive execution may split. Self-loops and null ends
    are ignored; no edges give an empty result.
    """
    def priority(name: str):
        return F.struct(F.xxhash64(F.col(name), F.lit(round_)).alias("h"), F.col(name).alias("id"))

    round_ = 0
    edges = materialise(edges.select("a", "b").where("a <> b").distinct(), "edges")
    roots = None
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = materialise(
            both.groupBy("a").agg(F.min(priority("b")).alias("least"))
            .select(F.col("a").alias("node"), F.least("least", priority("a"))["id"].alias("parent")),
            "parents",
        )
        if roots is None:
            roots = parents.select("node", F.col("parent").alias("root"))
        else:
            moved = parents.select(F.col("node").alias("root"), "parent")
            roots = materialise(
                roots.join(moved, "root", "left").select("node", F.coalesce("parent", "root").alias("root")), "roots",
            )
        of_a = parents.select(F.col("node").alias("a"), F.col("parent").alias("x"))
        of_b = parents.select(F.col("node").alias("b"), F.col("parent").alias("y"))
        met = edges.join(of_a, "a").join(of_b, "b").where("x <> y")
        edges = materialise(met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        round_ += 1
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
