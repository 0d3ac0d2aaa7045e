"""Connected components by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import written


def components(spark, edges):
    """(id, root) for each node of edges (a, b): root is the smallest id reachable.
    Each round is written to the shared folder; partial minima keep hubs small."""
    both = written(spark, edges.select("a", "b").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(spark, both.groupBy(F.col("a").alias("id")).agg(
        F.least(F.min("b"), F.col("id")).alias("root")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("id", "b"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("root").alias("m")))
        new = labels.join(near, "id", "left").select("id", F.least("root", F.coalesce("m", "root")).alias("root"))
        jump = labels.select(F.col("id").alias("root"), F.col("root").alias("up"))
        new = new.join(jump, "root", "left").select("id", F.least("root", F.coalesce("up", "root")).alias("root"))
        new = written(spark, new, "labels")
        old = labels.withColumnRenamed("root", "was")
        if new.join(old, "id").where("root != was").isEmpty():
            return new
        labels = new
