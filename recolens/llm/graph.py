"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from recolens.llm.store import written

ROUNDS = 100
#: Labels of so many nodes go to all tasks; those of more meet their edges by shuffle.
SMALL = 200_000


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) with the smallest node of each component, for all nodes that have an edge.

    Labels fall towards the smallest node as in FastSV (Zhang, Azad and Buluc, 2020): in every round a
    node and its label take the smallest label's label among the node's neighbours, and each node skips
    to its label's label, until nothing changes. Every round is a written table. A node with very many
    edges, or a label with very many nodes, is only met by combining minima and by joins of two plain
    exchanges, whose skewed partitions adaptive execution splits.
    """
    # Written before it is turned round: `edges` may come from tasks that choose other joining edges
    # when they run again, and both directions must be of the same edges.
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    pairs = written(pairs.distinct(), "edges")
    both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    label = both.groupBy("u").agg(F.min("v").alias("v")).select(
        F.col("u").alias("node"), F.least("u", "v").alias("label")
    )
    label, state = written(label, "labels"), None
    for _ in range(ROUNDS):
        total, n = label.agg(F.sum(F.col("label").cast("decimal(38,0)")), F.count("*")).first()
        sent = F.broadcast if n <= SMALL else lambda df: df
        if total == state:
            return label.select("node", F.col("label").alias("component"))
        state = total
        up = label.select(F.col("node").alias("label"), F.col("label").alias("next"))
        skip = label.join(sent(up), "label").select("node", "next")
        near = both.join(sent(skip.select(F.col("node").alias("v"), "next")), "v").groupBy("u").agg(F.min("next").alias("next"))
        hooked = near.join(sent(label), near["u"] == label["node"]).select(F.col("label").alias("node"), "next")
        found = skip.unionAll(near.select(F.col("u").alias("node"), "next")).unionAll(hooked)
        label = written(found.groupBy("node").agg(F.min("next").alias("label")), "labels")
    raise RuntimeError("components did not settle")
