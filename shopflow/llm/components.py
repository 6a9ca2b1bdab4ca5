"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import saved


def _large(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to its smallest neighbour."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    out = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (smallest node reachable) of every linked node;
    ``links`` has long columns ``a`` and ``b``.  Each round is a written
    table; the driver sees a count and a checksum of it."""
    edges = saved(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    mark = _mark(edges)
    while True:
        edges = saved(_small(_large(edges)), "links")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
