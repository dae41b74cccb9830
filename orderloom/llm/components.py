"""Connected components of links between 64-bit ids, by alternating star contractions.

Each round points every node's larger neighbours, then its smaller ones, at its smallest
neighbour, until each component is a star around its smallest id. Rounds are logarithmic in
practice, a node's links are never gathered, and every round is a table in the shared folder,
so a lost executor costs only tasks of the current round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_dir


def _written(spark: SparkSession, links: DataFrame, path: str) -> tuple[DataFrame, tuple]:
    """The links stored once each, and a summary that tells equal sets."""
    links.distinct().write.parquet(path)
    stored = spark.read.parquet(path)
    parts = [F.xxhash64("u", "v").cast("decimal(38,0)")]
    return stored, tuple(stored.agg(F.count("u"), *[F.sum(p) for p in parts]).first())


def _with_smallest(links: DataFrame) -> DataFrame:
    """Each link (u, v) with m, the smallest of u and all its partners."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("node"), F.least("u", "m").alias("m"))
    return links.join(least, links.u == least.node).drop("node")


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v): root is its component's smallest node."""
    base = scratch_dir(spark, "components")
    links = links.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                         F.least("u", "v").alias("v"))
    links, before = _written(spark, links, f"{base}/links")
    turn = 0
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_with_smallest(both).where("v > u").select(F.col("v").alias("u"), "m")
                 .withColumnRenamed("m", "v"))
        large, _ = _written(spark, large, f"{base}/large-{turn}")
        # Stored links point from the larger to the smaller id.
        near = _with_smallest(large)
        small = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            near.select("u", F.col("m").alias("v")))
        links, after = _written(spark, small, f"{base}/small-{turn}")
        if after == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before, turn = after, turn + 1
