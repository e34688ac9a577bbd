"""Connected components of an edge table by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import written


def _roots(spark: SparkSession, parents: DataFrame) -> DataFrame:
    """Follow ``parents`` (v, p with p <= v) to the end by pointer doubling."""
    while True:
        up = parents.select(F.col("v").alias("p"), F.col("p").alias("pp"))
        jumped = written(spark, parents.join(up, "p", "left")
                         .select("v", F.coalesce("pp", "p").alias("p"), (F.col("pp") < F.col("p")).alias("moved")))
        parents = jumped.select("v", "p")
        if jumped.where("moved").limit(1).isEmpty():
            return parents


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(v, root): the smallest node that each node of ``edges`` (a, b) can reach.

    Each round every node points to its smallest neighbour, the pointers are
    followed to their ends by doubling, and the edges are drawn between the
    ends; what is left shrinks by half or more. Neighbours are reduced with
    partial minimums, so that a node with very many edges fills no task.
    Every step is written to the shared folder. Loops are ignored and no
    edges give no rows.
    """
    edges = written(spark, edges.where("a <> b")
                    .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    while not edges.limit(1).isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("b"))
        roots = _roots(spark, written(spark, near.select(F.col("a").alias("v"), F.least("a", "b").alias("p"))))
        if labels is None:
            labels = roots.select("v", F.col("p").alias("root"))
        else:
            labels = written(spark, labels.join(roots.select(F.col("v").alias("root"), "p"), "root", "left")
                             .select("v", F.coalesce("p", "root").alias("root")))
        ra = roots.select(F.col("v").alias("a"), F.col("p").alias("ra"))
        rb = roots.select(F.col("v").alias("b"), F.col("p").alias("rb"))
        edges = written(spark, edges.join(ra, "a").join(rb, "b").where("ra <> rb")
                        .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
    if labels is None:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("root"))
    return labels
