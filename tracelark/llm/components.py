"""Connected components of a table of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .tables import written_by_cores


def _stars(links: DataFrame) -> bool:
    """Whether each larger end (a) has one link only and is no smaller end (b): then all links lead to a smallest node, and a round changes nothing."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        links.select("b", F.lit(0), F.lit(1))
    )
    counted = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    others = counted.agg(F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()
    return not others[0]


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of all nodes in ``links`` (two bigint columns a, b): root is the smallest node reachable.

    Each round joins links with one row per node, so no neighbourhood is
    gathered; the number of rounds grows with the logarithm of the longest
    path.  Links of a node with itself or repeated ones change nothing; no
    links give no rows.
    """
    current = written_by_cores(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links"
    )
    while not _stars(current):
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).union(current.select("b", "a"))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        # the row with b = m links a to it
        small = large.join(below, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        current = written_by_cores(small.distinct(), "links")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def joined_components(roots: DataFrame, more: DataFrame) -> DataFrame:
    """(node, root) after further links (a, b) between nodes of components (node, root) or others; the links of those are not needed again."""
    return connected_components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more.select("a", "b")))
