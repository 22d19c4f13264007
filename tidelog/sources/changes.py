"""Change-record sources: Kafka topics or files with the same columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructType

from tidelog.schemas import CHANGE_RECORD, QUARANTINE, conform
from tidelog.session import prepare
from tidelog.sinks.batches import batch_schema, read_batches, up_to

# Fixed value.
ORDERS_TOPIC = "poc.mydb.orders"


def kafka_options(
    servers: str,
    topics: str = ORDERS_TOPIC,
    starting_offsets: str = "earliest",
    max_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
    **more: str,
) -> dict[str, str]:
    """Options of the Kafka source.

    ``starting_offsets`` counts only for a query without a checkpoint: the
    checkpoint is where committed positions live. ``max_per_trigger`` bounds
    one micro-batch; size it to what the cluster writes within a trigger.
    Records lost to retention stop the query unless ``fail_on_data_loss`` is
    false; it then goes on from what is left.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics,
        "startingOffsets": starting_offsets,
        "includeHeaders": "true",
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options | more


def stream_from_kafka(spark: SparkSession, servers: str, **options) -> DataFrame:
    reader = prepare(spark).readStream.format("kafka").options(**kafka_options(servers, **options))
    return conform(reader.load(), CHANGE_RECORD)


def read_from_kafka(spark: SparkSession, servers: str, **options) -> DataFrame:
    """Bounded read up to the newest record."""
    reader = prepare(spark).read.format("kafka").options(**kafka_options(servers, **options))
    return conform(reader.load(), CHANGE_RECORD)


def stream_from_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream change records from Parquet files with the columns of the Kafka source."""
    reader = prepare(spark).readStream.schema(CHANGE_RECORD)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_from_files(spark: SparkSession, path: str) -> DataFrame:
    return prepare(spark).read.schema(CHANGE_RECORD).parquet(path)


def deliver_once(changes: DataFrame, within: str) -> DataFrame:
    """A stream without records that were delivered before: same topic, partition and offset.

    The state holds the positions that arrived within the last ``within``, no
    longer: a record delivered again after that passes. Time is that of
    arrival, so no record is ever too late and dropped unseen.
    """
    arrived = changes.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", within)
    return arrived.dropDuplicatesWithinWatermark(["topic", "partition", "offset"]).drop("_arrived")


def starting_at(changes: DataFrame, offsets: Mapping[str, Mapping[int | str, int]]) -> DataFrame:
    """Records at or behind a starting offset per partition, as Kafka's ``startingOffsets`` names them.

    Topics or partitions that are not named are read from their beginning. The
    test reaches the scan of stored logs: files and row groups whose offsets
    all lie before are not read.
    """
    for topic, partitions in offsets.items():
        for partition, start in partitions.items():
            elsewhere = (F.col("topic") != topic) | (F.col("partition") != int(partition))
            changes = changes.filter(elsewhere | (F.col("offset") >= start))
    return changes


def stream_quarantine_files(
    spark: SparkSession, path: str, after: Mapping[str, int] | None = None, max_files: int | None = None
) -> DataFrame:
    """Stream a stored quarantine dataset as messages: ``value`` is the JSON payload.

    ``after`` (stream -> batch) skips the batches up to there; ``quarantine_end``
    tells the latest ones. Their files are not opened.
    """
    if after:
        records = _stream_batches(spark, QUARANTINE, max_files).option("basePath", path).schema(batch_schema(QUARANTINE))
        records = records.parquet(f"{path}/stream=*").filter(~up_to(after))
    else:
        records = _stream_batches(spark, QUARANTINE, max_files).option("recursiveFileLookup", "true").parquet(path)
    payload = F.to_json(F.struct(*QUARANTINE.names), {"ignoreNullFields": "false"})
    return records.select(payload.cast("binary").alias("value"))


def _stream_batches(spark: SparkSession, schema: StructType, max_files: int | None = None) -> DataStreamReader:
    """A reader of batches (sinks.batches). Their partition columns are taken only where they are needed, as a stream
    fixes them when it starts, before there may be any."""
    reader = prepare(spark).readStream.schema(schema)
    return reader.option("maxFilesPerTrigger", max_files) if max_files else reader


def quarantine_end(spark: SparkSession, path: str) -> dict[str, int]:
    """The last stored batch of each stream: where a reader of new messages begins. One row per stream."""
    stored = read_batches(prepare(spark), path, QUARANTINE).groupBy("stream").agg(F.max("batch").alias("batch"))
    return {row["stream"]: row["batch"] for row in stored.collect()}


def stream_replay_log(spark: SparkSession, path: str) -> DataFrame:
    """Stream the messages a replay has written (sinks.topics), as change records."""
    return _stream_batches(spark, CHANGE_RECORD).option("recursiveFileLookup", "true").parquet(path)
