"""Change records to event columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidelog.functions import json_text as J
from tidelog.functions.times import is_timestamp_ms, or_ingest_time, timestamp_to_ms
from tidelog.spec import SPECS, CollectionSpec

# Operation codes and error texts.
WRITE_OPS = ("c", "u", "r")
DELETE_OP = "d"
TOMBSTONE = "tombstone"
UNKNOWN = "unknown"
ERROR_ENVELOPE = "Malformed Debezium envelope"
ERROR_AFTER = "Malformed 'after' JSON string"
ERROR_NUMBER = "Malformed extended JSON number"

RETRY_HEADER = "retry_count"


def collection_of(topic: Column) -> Column:
    """Last dot-separated segment of a topic name."""
    return F.substring_index(topic, ".", -1)


def normal_op(op: Column) -> Column:
    return F.when(op.isin(*WRITE_OPS, DELETE_OP), op).otherwise(UNKNOWN)


def document_size(value: Column) -> Column:
    """Bytes of the raw value, 0 for a tombstone."""
    return F.coalesce(F.octet_length(value), F.lit(0))


def retry_count_of(headers: Column) -> Column:
    """Retry count from the record headers, the last one if repeated."""
    matching = F.filter(headers, lambda h: h["key"] == RETRY_HEADER)
    text = F.try_element_at(matching, F.lit(-1))["value"].cast("string")
    return F.coalesce(text.try_cast("int"), F.lit(0))


def with_key_id(df: DataFrame, wanted: Column) -> DataFrame:
    """Add ``key_id``: the document id held in the record key, ``''`` if there is none.

    The id in the key is JSON text inside JSON. A plain text id is kept as it
    is. ``wanted`` limits the work to rows that use the result.
    """
    df = df.withColumn("_key_wrapped", J.object_text(F.when(wanted, J.utf8_text(F.col("key")))))
    df = df.withColumn("_key", J.read_object(F.col("_key_wrapped"), ["id"]))
    df = df.withColumn("_key_raw", J.object_or_null(F.col("_key"))["id"]).withColumn("_key_text", F.col("_key_raw"))
    df = J.coerce_extended(df, "_key_text")
    df = df.withColumn("_key_value", J.parse_value(F.col("_key_text")))
    return df.withColumn(
        "key_id", F.coalesce(J.value_or_null(F.col("_key_value")), F.col("_key_raw"), F.lit(""))
    ).drop("_key", "_key_wrapped", "_key_raw", "_key_text", "_key_value")


def document_fields_read(specs: Sequence[CollectionSpec]) -> list[str]:
    """Every document field a spec requires or a target reads."""
    names: dict[str, None] = {}
    for spec in specs:
        names.update(dict.fromkeys(spec.required))
        if spec.targets:
            names.update(dict.fromkeys(name for name, _ in spec.fields))
    return list(names)


def parse_changes(
    records: DataFrame, ingest_ms: Column | None = None, specs: Sequence[CollectionSpec] = SPECS
) -> DataFrame:
    """Parse change records into event columns; a bad record gets ``parse_error`` instead of failing.

    Adds ``collection, op, ts_ms, ts_valid, event_ms, doc_id, document, document_text, document_empty,
    has_document,
    kafka_ts_ms, doc_size_bytes, retry_count, parse_error`` and ``f_<name>`` as text
    for every document field the specs mention. Only built-in expressions are
    used, so the same code serves batches and streams. ``ingest_ms`` stands in
    for missing event times (default: now). ``document_text`` is the JSON text of the
    document, ``document`` the same as a VARIANT; each is built only for readers that select it.
    """
    ingest_ms = timestamp_to_ms(F.current_timestamp()) if ingest_ms is None else ingest_ms
    names = document_fields_read(specs)

    # Everything that needs the raw bytes comes first, so they are carried on
    # only for readers that select them.
    df = records.withColumns(
        {
            "_wrapped": J.object_text(J.utf8_text(F.col("value"))),
            "_tombstone": F.col("value").isNull(),
            "collection": collection_of(F.col("topic")),
            "kafka_ts_ms": timestamp_to_ms(F.col("timestamp")),
            "doc_size_bytes": document_size(F.col("value")),
            "retry_count": retry_count_of(F.col("headers")),
        }
    )
    df = df.withColumn("_parsed", J.read_object(F.col("_wrapped"), ["op", "ts_ms", "after"]))
    df = df.withColumn("_envelope", J.object_or_null(F.col("_parsed")))
    tombstone = F.col("_tombstone")
    df = df.withColumns(
        {
            "_bad_envelope": ~tombstone & F.col("_envelope").isNull(),
            "op": F.when(tombstone, F.lit(TOMBSTONE)).otherwise(normal_op(F.col("_envelope.op"))),
            "_ts_text": F.col("_envelope.ts_ms"),
            "_after": F.col("_envelope.after"),
            "_doc_text": F.col("_envelope.after"),
        }
    )
    df = J.coerce_extended(df, "_doc_text")
    from_key = tombstone | ((F.col("op") == DELETE_OP) & F.col("_after").isNull())
    df = df.withColumn("_wrapped", J.object_text(F.col("_doc_text")))
    df = df.withColumn("_parsed", J.read_object(F.col("_wrapped"), ["_id", *names]))
    df = df.withColumn("_doc", J.object_or_null(F.col("_parsed")))
    df = with_key_id(df, from_key)
    df = df.withColumn("ts_ms", F.coalesce(F.col("_ts_text").try_cast("bigint"), F.lit(0)))

    return df.select(
        *records.columns,
        "collection",
        "op",
        "ts_ms",
        # A whole number that a timestamp can hold, or none at all.
        (
            F.col("_ts_text").isNull()
            | (F.col("_ts_text").rlike(r"^-?\d+$") & F.coalesce(is_timestamp_ms(F.col("_ts_text").try_cast("bigint")), F.lit(False)))
        ).alias("ts_valid"),
        or_ingest_time(F.col("ts_ms"), ingest_ms).alias("event_ms"),
        F.when(from_key, F.col("key_id")).otherwise(F.coalesce(F.col("_doc._id"), F.lit(""))).alias("doc_id"),
        F.when(F.col("_doc").isNotNull(), F.try_parse_json(F.col("_doc_text"))).alias("document"),
        F.when(F.col("_doc").isNotNull(), F.col("_doc_text")).alias("document_text"),
        F.coalesce(J.is_empty_object(F.col("_doc_text")), F.lit(False)).alias("document_empty"),
        "kafka_ts_ms",
        "doc_size_bytes",
        "retry_count",
        F.when(F.col("_bad_envelope"), F.lit(ERROR_ENVELOPE))
        .when(F.col("_after").isNotNull() & F.col("_doc").isNull(), F.lit(ERROR_AFTER))
        .when(J.has_bad_number(F.col("_doc_text")), F.lit(ERROR_NUMBER))
        .alias("parse_error"),
        F.col("_doc").isNotNull().alias("has_document"),
        *(F.col("_doc")[name].alias(f"f_{name}") for name in names),
    )
