"""Connected components of links between documents, without gathering them anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, shared_dir, stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and component (the smallest node that it reaches) of each node that has a link.

    In each round a node takes the least label among its own and its neighbours', and then the label of that label. Every
    round's labels are a table in the shared folder, so that no lineage grows and no executor is needed for what is done; the
    tables of earlier rounds are deleted. Rounds grow with the logarithm of the longest chain, about.
    """
    spark, k = links.sparkSession, 0
    folder = shared_dir(spark)
    both = links.select(F.col(a).alias("u"), F.col(b).alias("v"))
    edges = stored(both.union(both.select("v", "u")).where("u <> v").distinct(), f"{folder}/edges")
    labels = stored(edges.groupBy(F.col("u").alias("node")).agg(F.least(F.col("u"), F.min("v")).alias("component")), f"{folder}/0")
    while True:
        near = edges.join(labels, edges["v"] == labels["node"]).groupBy("u").agg(F.min("component").alias("least"))
        step = labels.join(near, labels["node"] == near["u"]).select("node", F.least("component", "least").alias("next"), F.col("component").alias("was"))
        jump = labels.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
        step = stored(step.join(jump, step["next"] == jump["_n"], "left").select("node", F.least("next", F.coalesce("_c", "next")).alias("component"), "was"), f"{folder}/{k + 1}")
        if step.where("component <> was").isEmpty():
            dropped(spark, f"{folder}/edges", f"{folder}/{k + 1}")
            return labels
        dropped(spark, f"{folder}/{k}")
        labels, k = step.select("node", "component"), k + 1
