"""Quarantine records, the retry guard and the replay plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidelog.functions import json_text as J
from tidelog.functions.rows import never
from tidelog.functions.times import iso_text
from tidelog.operators.classify import QUARANTINED
from tidelog.operators.parse import RETRY_HEADER

# Fixed values.
QUARANTINE_TOPIC = "poc.dlq"
MAX_RETRIES = 3
FROM_PARTITION, FROM_OFFSET = "source_partition", "source_offset"
REPLAYED, DEAD, SKIPPED, QUEUED = "replayed", "dead", "skipped", "dlq"

PAYLOAD = (
    "source_topic", "source_partition", "source_offset", "error", "retry_count", "failed_at", "raw_value", "raw_key",
)


def _readable(binary: Column) -> Column:
    """Bytes as text with invalid sequences replaced; null when there are none."""
    return F.when(F.octet_length(binary) > 0, F.make_valid_utf8(binary.cast("string")))


def quarantine_records(events: DataFrame, failed_at: Column | None = None) -> DataFrame:
    """Records of the rejected events. ``destination`` is ``dead`` once the retries are used up."""
    failed_at = F.current_timestamp() if failed_at is None else failed_at
    return events.filter(F.col("disposition") == QUARANTINED).select(
        F.col("topic").alias("source_topic"),
        F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"),
        "error",
        "retry_count",
        iso_text(failed_at).alias("failed_at"),
        _readable(F.col("value")).alias("raw_value"),
        _readable(F.col("key")).alias("raw_key"),
        F.when(F.col("retry_count") >= MAX_RETRIES, DEAD).otherwise(QUEUED).alias("destination"),
    )


def quarantine_messages(records: DataFrame) -> DataFrame:
    """Queued records as messages of the quarantine topic, for a Kafka or file sink."""
    payload = F.to_json(F.struct(*PAYLOAD), {"ignoreNullFields": "false"})
    return records.filter(F.col("destination") == QUEUED).select(
        F.lit(QUARANTINE_TOPIC).alias("topic"), payload.cast("binary").alias("value")
    )


def dead_letters(records: DataFrame) -> DataFrame:
    return records.filter(F.col("destination") == DEAD).select(*PAYLOAD)


def plan_replay(messages: DataFrame) -> DataFrame:
    """What to do with each quarantine message.

    Adds ``action`` and the message to produce (``topic``, ``key``, ``value``,
    ``headers``); the retry count goes up before the guard looks at it. An
    unreadable envelope, a missing source topic or a retry count that is no
    number is skipped. The key is carried over, so deletes stay deletes.
    """
    df = messages.withColumn("_parsed", J.parse_object(J.utf8_text(F.col("value").cast("binary")), PAYLOAD))
    df = df.withColumn("_p", J.object_or_null(F.col("_parsed")))
    count = F.when(F.col("_p.retry_count").isNull(), 0).otherwise(F.col("_p.retry_count").try_cast("int")) + 1
    df = df.withColumn("_count", count)
    action = (
        F.when(never(), F.lit(None).cast("string"))
        .when(F.col("_p").isNull() | (F.coalesce(F.col("_p.source_topic"), F.lit("")) == ""), SKIPPED)
        .when(F.col("_count").isNull(), SKIPPED)
        .when(F.col("_count") > MAX_RETRIES, DEAD)
        .otherwise(REPLAYED)
    )
    header = F.struct(
        F.lit(RETRY_HEADER).alias("key"), F.col("_count").cast("string").cast("binary").alias("value")
    )
    rest = [c for c in messages.columns if c not in ("topic", "key", "value", "headers")]
    return df.select(
        *rest,
        action.alias("action"),
        F.col("_count").alias("retry_count"),
        F.col("_p.source_topic").alias("topic"),
        F.encode(F.col("_p.raw_key"), "UTF-8").alias("key"),
        F.coalesce(F.encode(F.col("_p.raw_value"), "UTF-8"), F.lit(b"")).alias("value"),
        F.array(header).alias("headers"),
        *(F.col("_p")[name].alias(name) for name in PAYLOAD if name not in ("retry_count",)),
    )


def first_messages(messages: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` messages in log order; 0 means all of them."""
    return messages.orderBy("partition", "offset").limit(limit) if limit else messages


def replay_messages(plan: DataFrame) -> DataFrame:
    """Messages to produce, each to its own source topic. Headers behind the retry count tell the position they failed at."""
    position = (
        F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("key"), F.col(c).cast("string").cast("binary").alias("value")))
        for c in (FROM_PARTITION, FROM_OFFSET)
    )
    headers = F.concat("headers", F.array_compact(F.array(*position))).alias("headers")
    return plan.filter(F.col("action") == REPLAYED).select("topic", "key", "value", headers)


def replay_dead_letters(plan: DataFrame) -> DataFrame:
    return plan.filter(F.col("action") == DEAD).select(*PAYLOAD)


def count_actions(plan: DataFrame) -> DataFrame:
    return plan.groupBy("action").agg(F.count("*").alias("n"))
