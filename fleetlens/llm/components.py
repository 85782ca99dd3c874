"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u points to the smallest node of u's neighbourhood and u."""
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.min("v").alias("m"))
    return (
        near.where("v > u")
        .join(least.select("u", F.least("u", "m").alias("m")), "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours point to the smallest of them (edges come with u > v)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(spark: SparkSession, edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v, both long); component is its smallest node.

    Loops and repeated edges are allowed; no edge gives no row. Each round is written in the
    shared folder; the rounds (a logarithm of the longest path in practice) end when the edges
    no longer change, and it is an error if they still do after ``rounds``.
    """
    now = written(
        spark,
        edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    state = None
    for _ in range(rounds):
        new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state or not new[0]:
            break
        state = new
        now = written(spark, _small_star(_large_star(now)), "edges")
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
