"""Fields that documents carry and their collection does not know: stored as they are, and summed up by type."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def drift_fields(drift: DataFrame) -> DataFrame:
    """One row per unknown field of a stored event, ``value`` being a VARIANT. A re-delivered event counts once."""
    once = drift.dropDuplicates(["topic", "partition", "offset"])
    fields = F.explode(F.col("extra").try_cast("map<string, variant>")).alias("field", "value")
    return once.select("collection", "doc_id", "topic", "partition", "offset", "event_ms", fields)


def drift_types(drift: DataFrame) -> DataFrame:
    """Per collection and unknown field: its events, when it was first and last seen, and the type all its values fit.

    Types are merged like counts, per task first: a field in every document is
    no hot key.
    """
    return drift_fields(drift).groupBy("collection", "field").agg(
        F.count("*").alias("n"),
        F.min("event_ms").alias("first_ms"),
        F.max("event_ms").alias("last_ms"),
        F.schema_of_variant_agg("value").alias("type"),
    )
