"""Checks that the targets hold what the source and its log say.

Every check returns a DataFrame. The joined sides are unique per key, so a join
never multiplies rows and no key is hotter than another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidelog.functions.rows import one_row

# Fixed values.
PARITY_TOLERANCE = 5
LATENCY_LIMIT_MS = 2000


def count_parity(source: DataFrame, target: DataFrame, tolerance: int = PARITY_TOLERANCE) -> DataFrame:
    """Row counts of both sides, their distance and whether it is within the tolerance."""
    both = one_row(source.agg(F.count("*").alias("source_rows")), target.agg(F.count("*").alias("target_rows")))
    diff = F.abs(F.col("source_rows") - F.col("target_rows"))
    return both.select("*", diff.alias("diff"), (diff <= tolerance).alias("passed"))


def key_parity(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Keys present on one side only, with the side that has them."""
    left = source.select(key, F.lit(True).alias("_s"))
    right = target.select(key, F.lit(True).alias("_t"))
    return (
        left.join(right, key, "full_outer")
        .filter(F.col("_s").isNull() | F.col("_t").isNull())
        .select(key, F.when(F.col("_s").isNull(), "target").otherwise("source").alias("only_in"))
    )


def insert_visible(
    written: DataFrame, targets: dict[str, DataFrame], key: str, e2e_ms: Column, limit_ms: int = LATENCY_LIMIT_MS
) -> DataFrame:
    """How many written keys reached each target and how many met the latency limit."""
    checked = written.select(key, (e2e_ms < limit_ms).alias("_fast"))
    for name, table in targets.items():
        checked = checked.join(table.select(key, F.lit(True).alias(f"in_{name}")), key, "left")
    return checked.agg(
        F.count("*").alias("written"),
        *(F.count(f"in_{name}").alias(f"in_{name}") for name in targets),
        F.count_if("_fast").alias("within_limit"),
    )


def update_propagated(source: DataFrame, target: DataFrame, key: str, column: str) -> DataFrame:
    """Compare one column of the source state with the target, as counts."""
    joined = source.select(key, F.col(column).alias("_want")).join(
        target.select(key, F.col(column).alias("_have"), F.lit(True).alias("_found")), key, "left"
    )
    same = F.col("_want").eqNullSafe(F.col("_have")) & F.col("_found").isNotNull()
    return joined.agg(
        F.count("*").alias("checked"), F.count_if(same).alias("equal"), F.count_if(~same).alias("different")
    )


def delete_propagated(deleted: DataFrame, targets: dict[str, DataFrame], key: str) -> DataFrame:
    """Deleted keys that are still present in a target; all zero when deletes arrived."""
    checked = deleted.select(key)
    for name, table in targets.items():
        checked = checked.join(table.select(key, F.lit(True).alias(f"in_{name}")), key, "left")
    return checked.agg(F.count("*").alias("deleted"), *(F.count(f"in_{name}").alias(f"left_in_{name}") for name in targets))


def duplicate_keys(table: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once."""
    return table.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, one row each."""
    frames = [t.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n") for name, t in tables.items()]
    counts = frames[0]
    for frame in frames[1:]:
        counts = counts.unionByName(frame)
    return counts
