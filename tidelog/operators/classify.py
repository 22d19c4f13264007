"""Validation, drift detection, disposition and routing of parsed events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidelog.functions import json_text as J
from tidelog.functions.rows import never
from tidelog.operators.parse import DELETE_OP, TOMBSTONE, WRITE_OPS
from tidelog.spec import SPECS, CollectionSpec

# Dispositions and error texts.
SKIPPED_TOMBSTONE = "skipped_tombstone"
SKIPPED_NO_ROUTE = "skipped_no_route"
QUARANTINED = "dlq"
UPSERT = "upsert"
DELETE = "delete"
ERROR_SCHEMA = "schema_validation_failed"
ERROR_TOTAL = "transform_failed: "
ERROR_NO_ID = "transform_failed: _id"
ERROR_TIME = "transform_failed: ts_ms"


def field_of(name: str) -> Column:
    """Document field as text, null when missing or JSON null."""
    return F.col(f"f_{name}")


def _by_collection(specs: Sequence[CollectionSpec], pick, otherwise: Column) -> Column:
    """One expression choosing by collection, for specs where ``pick`` gives a column."""
    chain = None
    for spec in specs:
        value = pick(spec)
        if value is None:
            continue
        test = F.col("collection") == spec.name
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    return otherwise if chain is None else chain.otherwise(otherwise)


def missing_fields(specs: Sequence[CollectionSpec] = SPECS) -> Column:
    """Names of required fields that are absent or null, empty for unknown collections."""
    none = F.array().cast("array<string>")

    def missing(spec: CollectionSpec):
        if not spec.required:
            return None
        names = F.array(*(F.when(field_of(f).isNull(), F.lit(f)) for f in spec.required))
        return F.filter(names, lambda n: n.isNotNull())

    return _by_collection(specs, missing, none)


def extra_fields(specs: Sequence[CollectionSpec] = SPECS) -> Column:
    """Document entries outside the known fields as MAP<STRING, VARIANT>.

    In a collection without known fields every entry counts as drift. Only
    documents with an unknown name among theirs are turned into variants.
    """
    known = _by_collection(
        specs,
        lambda s: F.array(*map(F.lit, s.known)) if s.known else None,
        F.array().cast("array<string>"),
    )
    text = F.col("document_text")
    entries = F.try_parse_json(text).try_cast("map<string, variant>")
    # Null, so not skipped, where the names cannot be told.
    drifted = F.array_size(F.array_except(F.json_object_keys(text), known)) > 0
    return F.when(~drifted, F.create_map().cast("map<string, variant>")).otherwise(
        F.map_filter(entries, lambda name, _: ~F.array_contains(known, name))
    )


def is_valid(specs: Sequence[CollectionSpec] = SPECS) -> Column:
    """Whether an event may be written: deletes always, others need a document with its required fields."""

    def complete(spec: CollectionSpec):
        test = F.lit(True)
        for name in spec.required:
            test = test & field_of(name).isNotNull()
        return test if spec.required else None

    has_document = F.col("has_document") & ~F.col("document_empty")
    return F.col("op").isin(DELETE_OP, TOMBSTONE) | (
        has_document & _by_collection(specs, complete, F.lit(True))
    )


def is_routed(specs: Sequence[CollectionSpec] = SPECS) -> Column:
    names = [s.name for s in specs if s.targets]
    return F.col("collection").isin(*names) & F.col("op").isin(*WRITE_OPS, DELETE_OP)


def with_numbers(events: DataFrame, specs: Sequence[CollectionSpec] = SPECS) -> DataFrame:
    """Add ``n_<name>`` for the numeric fields targets read; validation and projection share it."""
    numeric = {name for spec in specs if spec.targets for name, kind in spec.fields if kind == "double"}
    return events.withColumns({f"n_{n}": J.number_or_null(field_of(n)) for n in sorted(numeric)}) if numeric else events


def bad_number_field(specs: Sequence[CollectionSpec] = SPECS) -> Column:
    """Name of the first numeric document field whose text is not a number, else null."""

    def first_bad(spec: CollectionSpec):
        tests = [
            F.when(field_of(n).isNotNull() & F.col(f"n_{n}").isNull(), F.lit(n))
            for n, kind in spec.fields
            if kind == "double"
        ]
        return F.coalesce(*tests) if spec.targets and tests else None

    return _by_collection(specs, first_bad, F.lit(None).cast("string"))


def classify(parsed: DataFrame, specs: Sequence[CollectionSpec] = SPECS) -> DataFrame:
    """Add ``disposition`` and ``error`` to parsed events.

    The rules apply in the order written here. Every expression is total, so
    one bad event never fails the others of its batch.

    The disposition is pinned (functions.rows.never): filters on the outcome do
    not repeat the parse.
    """
    events = with_numbers(parsed, specs).withColumns(
        {
            "_valid": is_valid(specs),
            "_routed": is_routed(specs),
            "_bad_field": F.when(F.col("op").isin(*WRITE_OPS), bad_number_field(specs)),
        }
    )
    writes = F.col("op").isin(*WRITE_OPS)
    error = (
        F.when(F.col("op") == TOMBSTONE, F.lit(None).cast("string"))
        .when(F.col("parse_error").isNotNull(), F.col("parse_error"))
        .when(~F.col("_valid"), F.lit(ERROR_SCHEMA))
        .when(~F.col("_routed"), F.lit(None).cast("string"))
        .when(~F.col("ts_valid"), F.lit(ERROR_TIME))
        .when(writes & (F.col("doc_id") == ""), F.lit(ERROR_NO_ID))
        .when(F.col("_bad_field").isNotNull(), F.concat(F.lit(ERROR_TOTAL), F.col("_bad_field")))
    )
    events = events.withColumn("error", error)
    disposition = (
        F.when(never(), F.lit(None).cast("string"))
        .when(F.col("op") == TOMBSTONE, F.lit(SKIPPED_TOMBSTONE))
        .when(F.col("error").isNotNull(), F.lit(QUARANTINED))
        .when(~F.col("_routed"), F.lit(SKIPPED_NO_ROUTE))
        .when(F.col("op") == DELETE_OP, F.lit(DELETE))
        .otherwise(F.lit(UPSERT))
    )
    aside = {"_valid", "_routed", "_bad_field", "has_document", "document_empty", "ts_valid", "parse_error"}
    return events.select(*(c for c in events.columns if c not in aside), disposition.alias("disposition"))


def routes(events: DataFrame, specs: Sequence[CollectionSpec] = SPECS) -> DataFrame:
    """One row per event and target table: ``db_target, table, is_delete``."""

    def fan_out(spec: CollectionSpec):
        if not spec.targets:
            return None
        return F.array(
            *(
                F.struct(
                    F.lit(t.database).alias("db_target"),
                    F.lit(t.table).alias("table"),
                    (F.col("disposition") == DELETE).alias("is_delete"),
                )
                for t in spec.targets
            )
        )

    kind = "array<struct<db_target: string, table: string, is_delete: boolean>>"
    targets = _by_collection(specs, fan_out, F.array().cast(kind))
    applied = F.col("disposition").isin(UPSERT, DELETE)
    return events.filter(applied).withColumn("_route", F.explode(targets)).select(
        *events.columns, "_route.db_target", "_route.table", "_route.is_delete"
    )


def count_dispositions(events: DataFrame) -> DataFrame:
    """Deliveries per disposition: a re-delivered record counts each time, so sums do not depend on the batches."""
    return events.groupBy("disposition").agg(F.count("*").alias("n"))
