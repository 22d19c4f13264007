"""Exact interpolated percentiles of a BIGINT column that scale with the cluster.

A single percentile aggregate would gather every distinct value in one task.
Here the values are counted by a distributed aggregate first. The ranks wanted
are then located level by level: among the values' leading bits, then among the
next ones of those that hold a rank. No task ever sees more than 2**19 counts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

#: Bits below each level, and below the one before it. A span between two timestamps has less than 55 bits.
LEVELS = ((38, None), (19, 38), (0, 19))


def exact_percentiles(df: DataFrame, column: str, points: Mapping[str, float]) -> DataFrame:
    """One row with a DOUBLE per entry of ``points`` (name -> fraction); null if there is no value.

    Interpolates linearly between the two neighbouring ranks, as SQL's
    ``percentile_cont`` does.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("bigint").alias("v")).agg(F.count("*").alias("n"))
    return percentiles_of_counts(counts, points)


def percentiles_of_counts(counts: DataFrame, points: Mapping[str, float]) -> DataFrame:
    """The same from counted values, ``v`` and ``n``, a row per value."""
    wanted = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(p).alias("p")) for name, p in points.items()))
    # Two ranks per point: a fixed handful of rows.
    ranks = (
        counts.agg(F.sum("n").alias("total"))
        .select("total", F.explode(wanted).alias("w"))
        .select(F.col("w.name").alias("name"), (F.col("w.p") * (F.col("total") - 1)).alias("position"))
        .withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("position"), F.ceil("position")))))
        .select("*", F.lit(0).cast("bigint").alias("before"), F.lit(0).cast("bigint").alias("leading"))
    )
    in_order = Window.partitionBy("name", "rank").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for below, above in LEVELS:
        parts = counts.select("n", (F.lit(0).cast("bigint") if above is None else F.shiftright("v", above)).alias("leading"), F.shiftright("v", below).alias("part"))
        held = parts.join(F.broadcast(ranks), "leading").groupBy("name", "rank", "position", "before", "part").agg(F.sum("n").alias("n"))
        upto = held.withColumn("upto", F.col("before") + F.sum("n").over(in_order))
        found = upto.filter((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
        ranks = found.select("name", "position", "rank", (F.col("upto") - F.col("n")).alias("before"), F.col("part").alias("leading"))
    low, high = F.min("leading"), F.max("leading")
    fraction = F.max("position") - F.min("rank")
    per_point = ranks.groupBy("name").agg((low + (high - low) * fraction).cast("double").alias("value"))
    return per_point.agg(*(F.max(F.when(F.col("name") == name, F.col("value"))).alias(name) for name in points))
