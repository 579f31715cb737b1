"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import discard, run_folder
from .common import staged


def _least(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each ``a``, itself included. Summed before the shuffle, so a hub costs a row a task."""
    return edges.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))


def _round(edges: DataFrame, folder: str) -> DataFrame:
    """One large star and one small star. The least neighbours are written before they are joined: both sides of a
    join then come from exchanges of its own, and the rows of a hub can be split."""
    both = edges.union(edges.select("b", "a"))
    low = staged(_least(both), "low", folder)
    large = staged(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct(), "large", folder)
    least = staged(_least(large), "least", folder)
    linked = large.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return linked.union(least.select("a", "low")).where("a <> b").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of ``edges`` (``a``, ``b``) but the roots; a root is its component's smallest node.

    Each round is written to the shared folder, where it takes the place of the round before, and only its count and a
    checksum come to the driver. The stars have converged when a round changes nothing.
    """
    spark = edges.sparkSession
    orient = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    folder = run_folder(spark, "components")
    current, seen = staged(orient, "edges", folder), None
    while True:
        mark = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before, folder = folder, run_folder(spark, "components")
        current, seen = staged(_round(current, folder), "edges", folder), mark
        discard(spark, before)
