"""Connected components by alternating large-star and small-star steps, on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.scratch import keep


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's larger (or smaller) neighbours to the least of its neighbours and itself."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    linked = joined.filter(F.col("b") > F.col("a")) if large else joined
    linked = linked.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        linked = linked.unionByName(least.select("a", F.col("m").alias("b")))
    return linked.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of its component, for each node of an edge (a, b) with a != b.

    Every round halves the depth of the trees; none gathers a component in one place, and stars around hot nodes are
    sums and joins that split. It ends when a round changes nothing.
    """
    now = keep(edges.filter(F.col("a") != F.col("b")).distinct(), "edges")
    mark = None
    while True:
        after = keep(_stars(_stars(now, True), False), "stars")
        found = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == mark:
            return after.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(after.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        now, mark = after, found
