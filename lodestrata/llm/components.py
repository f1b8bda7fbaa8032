"""Connected components by label propagation with shortcuts; every round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.store import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b): the label is the smallest node reachable.

    A round takes the smallest label among the neighbours and then the label of that label, so chains
    halve. Joins read two written tables, so a node with very many edges is split by the join.
    """
    both = saved(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = saved(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).select(F.col("a").alias("node"), "label"), "labels")
    while True:
        heard = saved(both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("heard")), "heard")
        nearer = saved(labels.join(heard, labels["node"] == heard["a"]).select("node", F.col("label").alias("was"), F.least("label", "heard").alias("via")), "nearer")
        known = nearer.select(F.col("node").alias("_n"), F.col("via").alias("label"))
        jumped = saved(nearer.join(known, nearer["via"] == known["_n"]).select("node", "was", "label"), "labels")
        if jumped.where("label <> was").isEmpty():
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")
