"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.session import store


def _stars(edges: DataFrame) -> DataFrame:
    """One large star and one small star; every edge points from ``u`` to a smaller ``v``."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.distinct()
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(low.withColumnRenamed("m", "v")).distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """The columns ``node`` and ``component``, its smallest node, for each node with a link.

    Links may be repeated, in any order, or join a node to itself; a null end is no link. Each
    round is written to the shared folder, so a lost executor costs one round at most, and a
    node with very many links is a partial minimum in many tasks and never one task's list.
    """
    ends = links.where(F.col(a) != F.col(b))
    edges = store(
        ends.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    before, now = None, _state(edges)
    while now != before:
        edges = store(_stars(edges), "edges")
        before, now = now, _state(edges)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
