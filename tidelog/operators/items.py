"""Line items unfolded from the ``items`` array of order documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidelog.functions import json_text as J


def line_items(orders: DataFrame, items: str = "items", key: str = "order_id") -> DataFrame:
    """One row per object in each order's item array; other entries are skipped.

    ``orders`` holds the current array per order, so unfolding it replaces the
    rows of an earlier version and drops those of deleted orders.
    """
    entries = F.try_variant_get(F.try_parse_json(F.col(items)), "$", "array<variant>")
    entry = orders.select(key, F.explode(entries).alias("_i")).filter(
        F.schema_of_variant(F.col("_i")).startswith("OBJECT")
    )
    text = {name: F.try_variant_get(F.col("_i"), f"$.{name}", "string") for name in ("sku", "qty", "unit_price")}
    return entry.select(
        key,
        text["sku"].alias("sku"),
        J.number_or_null(text["qty"]).alias("qty"),
        J.number_or_null(text["unit_price"]).alias("unit_price"),
    )
