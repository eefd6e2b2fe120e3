"""Connected components of links between keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stagecheck.llm.common import settle


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that ``links`` (a, b) name; the root is the least node of its component.

    Alternates two steps until nothing moves: every node hands its larger neighbours, then its
    smaller ones, to the least node it knows. Both are a minimum per node, which combines
    before its shuffle, and a join against one row for each node.

    Defined cases: a link to itself or to null is none; repeated links count once, in either direction;
    without links there are no rows; nodes may be of any type that can be ordered; other columns are not looked at.
    """
    edges = settle(_oriented(links), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = _oriented(_to_least(both, F.col("b") > F.col("a")))
        down = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
        edges = settle(_oriented(_to_least(down, F.lit(True)).unionByName(
            down.groupBy("a").agg(F.min("b").alias("b")))), "links")
        now = tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b") % (1 << 40)), F.lit(0))).first())
        if now == before:
            break
        before = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def _oriented(links: DataFrame) -> DataFrame:
    return links.select("a", "b").where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _to_least(links: DataFrame, wanted) -> DataFrame:
    """For each link (a, b): b goes to the least of a and all its neighbours."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    return links.join(least, "a").where(wanted).select(F.least("least", "a").alias("a"), "b")
