"""Events to target columns and to metric rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidelog.functions.times import clock_text, latency
from tidelog.operators.classify import DELETE, UPSERT
from tidelog.spec import ORDERS, CollectionSpec, Target


def document_fields(events: DataFrame, spec: CollectionSpec = ORDERS) -> DataFrame:
    """Applied events of one collection: key, position, times and the typed document fields.

    Deletes carry null fields. Raw bytes and the document itself are left out,
    so what is shuffled afterwards is only what the targets store.
    """
    fields = [
        (F.col(f"n_{name}") if kind == "double" else F.col(f"f_{name}").try_cast(kind)).alias(name)
        for name, kind in spec.fields
    ]
    applied = (F.col("collection") == spec.name) & F.col("disposition").isin(UPSERT, DELETE)
    return events.filter(applied).select(
        F.col("doc_id").alias(spec.key),
        "topic",
        "partition",
        "offset",
        "kafka_ts_ms",
        "event_ms",
        (F.col("disposition") == DELETE).alias("is_delete"),
        *fields,
    )


def target_columns(target: Target) -> list[Column]:
    return [F.expr(sql).alias(name) for name, sql in target.columns]


def metric_rows(events: DataFrame, recv_ms: Column, stored_ms: Column, recorded_at: Column) -> DataFrame:
    """Timing rows of the events that reached the write stage with both source times known."""
    mongo, kafka = F.col("ts_ms"), F.col("kafka_ts_ms")
    return events.filter((mongo > 0) & (kafka > 0)).select(
        "doc_id",
        "collection",
        F.col("op").alias("operation"),
        F.col("doc_size_bytes").cast("int").alias("doc_size_bytes"),
        mongo.alias("mongo_ts_ms"),
        kafka.alias("kafka_ts_ms"),
        recv_ms.alias("consumer_recv_ms"),
        stored_ms.alias("pg_stored_ms"),
        latency(mongo, kafka).alias("debezium_lat_ms"),
        latency(kafka, recv_ms).alias("consumer_lat_ms"),
        latency(recv_ms, stored_ms).alias("write_lat_ms"),
        latency(mongo, stored_ms).alias("e2e_lat_ms"),
        recorded_at.alias("recorded_at"),
        "topic",
        "partition",
        "offset",
    )


def recent_view(metrics: DataFrame) -> DataFrame:
    """Rename and format metric rows for display."""
    return metrics.select(
        "doc_id",
        "collection",
        F.col("operation").alias("op"),
        F.col("doc_size_bytes").alias("bytes"),
        clock_text(F.col("mongo_ts_ms")).alias("mongo_time"),
        clock_text(F.col("kafka_ts_ms")).alias("kafka_time"),
        clock_text(F.col("consumer_recv_ms")).alias("consumer_time"),
        clock_text(F.col("pg_stored_ms")).alias("pg_time"),
        F.col("debezium_lat_ms").alias("deb_ms"),
        F.col("consumer_lat_ms").alias("con_ms"),
        F.col("write_lat_ms").alias("wrt_ms"),
        F.col("e2e_lat_ms").alias("e2e_ms"),
    )
