"""Connected components by alternating star contraction, entirely in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwatch.llm.frames import materialise


def _written(least: DataFrame) -> DataFrame:
    """A join of two plain tables can be split where a node has very many neighbours."""
    return materialise(least, "least")


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node are hung under its smallest neighbour or itself."""
    near = _both_ways(edges)
    least = _written(near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return near.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are hung under the smallest of them; u > v throughout."""
    least = _written(edges.groupBy("u").agg(F.min("v").alias("m")))
    hung = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node and root (smallest node of its component) for all nodes that occur in ``links``.

    Each round is two hash aggregates and two joins; rounds grow with the
    logarithm of the longest path. Rounds are written to the shared folder, so
    a lost executor repeats tasks of one round only. The driver gets two
    numbers per round.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges = materialise(edges, "edges")
    state = None
    while True:
        seen = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if (seen["n"], seen["s"]) == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        state = (seen["n"], seen["s"])
        if not seen["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        edges = materialise(_small_star(materialise(_large_star(edges), "edges")), "edges")
