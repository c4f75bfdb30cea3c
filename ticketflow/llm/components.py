"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketflow.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of edges ``(a, b)``: the smallest node reachable.

    Each round every remaining node takes the smallest label around it (and
    that one's own, twice), the edges are relabelled and those inside a label
    dropped, until none is left. Both tables are written every round, so the
    plan stays short; null ends are ignored.
    """
    live = materialize(edges.where("a is not null and b is not null and a <> b")
                       .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    labels = live.select(F.col("a").alias("node")).union(live.select("b")).distinct().withColumn("component", F.col("node"))
    while not live.isEmpty():
        both = live.select("a", "b").union(live.select("b", "a"))
        step = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("to"))
        for _ in range(2):
            of = step.select(F.col("a").alias("to"), F.col("to").alias("next"))
            step = step.join(of, "to", "left").select("a", F.coalesce("next", "to").alias("to"))
        step = materialize(step, "cc-step")
        labels = materialize(
            labels.join(step, labels["component"] == step["a"], "left")
            .select("node", F.coalesce("to", "component").alias("component")), "cc-labels")
        a, b = step.select("a", F.col("to").alias("x")), step.select(F.col("a").alias("b"), F.col("to").alias("y"))
        live = materialize(live.join(a, "a").join(b, "b").where("x <> y")
                           .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "cc-edges")
    return labels
