"""Column layouts of change records, quarantine records, metrics and offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
    VariantType,
)

STRING, INT, BIGINT, DOUBLE, BOOLEAN = StringType(), IntegerType(), LongType(), DoubleType(), BooleanType()
BINARY, TIMESTAMP, DATE = BinaryType(), TimestampType(), DateType()


def struct(**columns: DataType) -> StructType:
    schema = StructType()
    for name, kind in columns.items():
        schema.add(name, kind)
    return schema


# What the Kafka source of Spark delivers with includeHeaders=true.
CHANGE_RECORD = struct(
    key=BINARY,
    value=BINARY,
    topic=STRING,
    partition=INT,
    offset=BIGINT,
    timestamp=TIMESTAMP,
    headers=ArrayType(struct(key=STRING, value=BINARY)),
)

# The first seven fields are the JSON payload; raw_key is ours, it lets a
# replayed delete find its document again.
QUARANTINE = struct(
    source_topic=STRING,
    source_partition=INT,
    source_offset=BIGINT,
    error=STRING,
    retry_count=INT,
    failed_at=STRING,
    raw_value=STRING,
    raw_key=STRING,
)

METRICS = struct(
    doc_id=STRING,
    collection=STRING,
    operation=STRING,
    doc_size_bytes=INT,
    mongo_ts_ms=BIGINT,
    kafka_ts_ms=BIGINT,
    consumer_recv_ms=BIGINT,
    pg_stored_ms=BIGINT,
    debezium_lat_ms=BIGINT,
    consumer_lat_ms=BIGINT,
    write_lat_ms=BIGINT,
    e2e_lat_ms=BIGINT,
    recorded_at=TIMESTAMP,
    success=BOOLEAN,
    topic=STRING,
    partition=INT,
    offset=BIGINT,
)

OFFSETS = struct(topic=STRING, partition=INT, committed=BIGINT, low=BIGINT, high=BIGINT)

OFFSET_AUDIT = struct(ts=STRING, group_id=STRING, topic=STRING, partition=INT, committed=BIGINT)

# What the audit of a stored batch adds: its first offset, and whether it holds every offset up to the last.
BATCH_AUDIT = StructType(list(OFFSET_AUDIT.fields)).add("low", BIGINT).add("unbroken", BOOLEAN)

COUNTERS = struct(disposition=STRING, n=BIGINT)

# Fields of accepted documents that their collection does not know, as one object.
DRIFT = struct(collection=STRING, doc_id=STRING, topic=STRING, partition=INT, offset=BIGINT, event_ms=BIGINT, extra=VariantType())

# Where the next message of a replay log's partition goes.
NEXT_POSITIONS = struct(topic=STRING, partition=INT, next=BIGINT)

# A merge state (operators.merge) without its key and payload.
STATE = struct(
    topic=STRING,
    partition=INT,
    last_offset=BIGINT,
    last_kafka_ms=BIGINT,
    deleted_offset=BIGINT,
    deleted_ms=BIGINT,
    first_offset=BIGINT,
    first_ms=BIGINT,
    is_delete=BOOLEAN,
    event_ms=BIGINT,
)

# One row per stream in a compacted version: the last batch folded into it.
COMMIT = struct(version=BIGINT, stream=STRING, batch=BIGINT, buckets=BIGINT)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast the columns of ``schema`` from ``df``; missing ones become null."""
    have = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )
