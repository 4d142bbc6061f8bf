"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tunequorum.runtime import durable


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the nodes of ``edges`` (a, b: long) and one node that stands for each component.

    In each round every node joins the neighbour (or itself) that a hash of the round puts first; the edges are then
    drawn between the joined nodes, and loops and repeated edges go. The number of nodes falls by a constant
    factor a round in expectation. Each round ends in written tables. No edges give no rows.
    """
    edges = durable(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    roots = None
    turn = 0
    while not edges.isEmpty():
        order = F.xxhash64(F.col("other"), F.lit(turn))
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        first = both.groupBy("node").agg(F.min(F.struct(order.alias("order"), "other")).alias("first"))
        own = F.struct(F.xxhash64(F.col("node"), F.lit(turn)).alias("order"), F.col("node").alias("other"))
        joined = durable(first.select("node", F.least("first", own)["other"].alias("to")))
        if roots is None:
            roots = joined.withColumnRenamed("to", "root")
        else:
            roots = roots.join(joined.withColumnRenamed("node", "root"), "root", "left").select(
                "node", F.coalesce("to", "root").alias("root")
            )
        roots = durable(roots)
        for end in ("a", "b"):
            edges = edges.join(joined.select(F.col("node").alias(end), F.col("to").alias(f"{end}_to")), end).drop(end)
        edges = durable(edges.where("a_to <> b_to").select(
            F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")
        ).distinct())
        turn += 1
    return roots if roots is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
