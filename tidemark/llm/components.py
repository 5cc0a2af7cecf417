"""Connected components of an edge table, by minimum labels and pointer jumping; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """edges: a, b (long, any direction). Returns node, comp: the smallest node that can be reached."""
    both = materialise(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct(), "edges")
    first = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("comp"))
    labels = materialise(first.select(F.col("a").alias("node"), "comp", F.lit(True).alias("moved")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("seen"))
        step = labels.join(near, labels["node"] == near["a"], "left").select("node", F.col("comp").alias("was"), F.least("comp", "seen").alias("comp"))
        root = labels.select(F.col("node").alias("_n"), F.col("comp").alias("_c"))
        jumped = F.least("comp", F.coalesce("_c", "comp"))
        new = step.join(root, step["comp"] == root["_n"], "left").select("node", jumped.alias("comp"), (F.col("was") != jumped).alias("moved"))
        new = materialise(new, "labels")
        discard(labels)
        labels = new
        if not labels.where("moved").limit(1).count():
            discard(both)
            return labels.drop("moved")
