"""Connected components by minimum labels and pointer jumping, on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); component is its smallest reachable node."""
    both = scratch.write(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct())
    labels = scratch.write(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        labels_now = labels.select("node", "label")
        near = both.join(labels_now.select(F.col("node").alias("b"), "label").hint("merge"), "b").select(F.col("a").alias("node"), "label")
        low = near.union(labels_now).groupBy("node").agg(F.min("label").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("root"))
        new = low.join(jump.hint("merge"), "label", "left").select("node", F.least("label", "root").alias("new"))
        step = scratch.write(labels.join(new.hint("merge"), "node").select("node", F.col("new").alias("label"), (F.col("new") < F.col("label")).alias("moved")))
        scratch.free(labels)
        labels = step
        if step.filter("moved").isEmpty():
            return labels.select("node", F.col("label").alias("component"))
