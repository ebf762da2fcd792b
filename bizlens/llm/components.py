"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizlens.llm import staging


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them (edges have u > v)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def _is_forest(edges: DataFrame) -> bool:
    """Whether every node either points to one other, or is only pointed to: stars, whose centres are the smallest."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    odd = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 OR (up = 1 AND down = 1)")
    return odd.agg(F.count(F.lit(1))).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """(u, v) for every node u of ``links`` (a, b) that is not the smallest of
    its component, v being the smallest. Only minima per node are computed, so a
    hub with many neighbours is an aggregate and a splittable join; each round's
    edges are a written table. It ends when the edges are stars.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = staging.staged(edges, "edges")
    while not _is_forest(edges):
        edges = staging.staged(_large_star(edges), "large-star")
        edges = staging.staged(_small_star(edges).distinct(), "small-star")
    return edges


def joined_components(parts: DataFrame, links: DataFrame) -> DataFrame:
    """``parts``, components as of :func:`components`, after ``links`` (a, b) between their smallest nodes."""
    moved = components(links)
    lower = parts.join(moved.toDF("v", "w"), "v", "left").select("u", F.coalesce("w", "v").alias("v"))
    return staging.staged(lower.unionByName(moved), "joined")
