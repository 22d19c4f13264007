"""Small relational helpers shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def one_row(*frames: DataFrame) -> DataFrame:
    """Put one-row frames with different columns side by side without a join."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*(F.max(F.col(c)).alias(c) for c in stacked.columns))


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0).cast("double"))


def never() -> Column:
    """A test that is never true and keeps Spark from moving filters below its projection.

    It looks at the task's partition id, so the optimizer must evaluate the
    projection where it stands. Later filters then work on its outcome instead
    of repeating costly expressions (JSON parsing) further down.
    """
    return F.spark_partition_id() < 0
