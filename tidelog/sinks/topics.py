"""Messages produced to topics: to a broker, or to a log of files with the columns of the Kafka source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelog.operators.quarantine import FROM_OFFSET, FROM_PARTITION
from tidelog.schemas import CHANGE_RECORD, conform
from tidelog.sinks.batches import Batch, batch_schema, create_dataset, read_batches, write_batch

#: Distance between a partition and the one that holds its replayed messages.
REPLAY_PARTITIONS = 1 << 20

#: Takes the messages of a batch (``topic, key, value, headers``, the position they failed at among the headers).
Produce = Callable[[DataFrame, Batch], None]


def _header(name: str) -> Column:
    """Text of the first header of that name, null without one."""
    return F.get(F.filter("headers", lambda h: h["key"] == name), F.lit(0))["value"].cast("string")


class ReplayLog:
    """A log of replayed messages as files under ``path``; call it with the messages of a batch.

    Nobody numbers messages here as a broker would. A message keeps the offset
    it failed at and moves to the partition ``REPLAY_PARTITIONS`` further on:
    no two messages share a position, those of a key keep their order, and a
    batch written again, or a message replayed again, has the position it had.
    Messages of foreign quarantines that do not know where they failed get a
    position from their content.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def create(self) -> "ReplayLog":
        create_dataset(self.spark, self.path, batch_schema(CHANGE_RECORD))
        return self

    def read(self) -> DataFrame:
        return read_batches(self.spark, self.path, CHANGE_RECORD)

    def __call__(self, messages: DataFrame, batch: Batch) -> None:
        unknown = F.pmod(F.xxhash64("topic", "key", "value"), F.lit(1 << 40))
        placed = messages.withColumns(
            {
                "partition": F.coalesce(_header(FROM_PARTITION).try_cast("int"), F.lit(0)) + REPLAY_PARTITIONS,
                "offset": F.coalesce(_header(FROM_OFFSET).try_cast("bigint"), unknown),
                "timestamp": F.current_timestamp(),
            }
        )
        write_batch(conform(placed, CHANGE_RECORD), self.path, batch)


def kafka_messages(messages: DataFrame) -> DataFrame:
    """The columns that the Kafka sink takes; each row names its topic."""
    return messages.select(*(F.col(c) for c in ("topic", "key", "value", "headers") if c in messages.columns))


def to_kafka(servers: str, **options: str) -> Produce:
    """Produces to a broker, which numbers the messages itself."""

    def produce(messages: DataFrame, batch: Batch) -> None:
        settings = {"kafka.bootstrap.servers": servers, "includeHeaders": "true"} | options
        kafka_messages(messages).write.format("kafka").options(**settings).save()

    return produce
