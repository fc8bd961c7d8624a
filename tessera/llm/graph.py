"""Connected components as alternating large-star / small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(least, "u").filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = (edges.join(least, "u").filter("v > m")
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of any orderable id -> ``(node, root)`` for every node that
    is not itself the least of its component.  Each round keeps the number of
    edges and moves them towards the least node, so a node of many links costs a
    partial minimum, not a gathered list.  No link: no rows."""
    e = (edges.filter("a <> b")
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = stored(spark, e, "edges")
    state = None
    while True:
        row = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
        if row["n"] == 0 or (row["n"], row["s"]) == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = (row["n"], row["s"])
        e = stored(spark, _small_star(_large_star(e)), "edges")
