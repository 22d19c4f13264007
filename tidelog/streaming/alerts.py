"""Alerts while the job runs: a topic falls silent without any record of it arriving, and speaks again.

Time is that of the records, the newest of all topics being now, and of a
heartbeat, if the stream has one: then silence of the whole log is noticed too.
No watermark is used, as it would drop the records of a topic that lags behind.
What is kept is one row per topic and batch; a batch repeated after a failure
starts from the state before it and replaces what it had written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators.lag import STALE_AFTER
from tidelog.schemas import BOOLEAN, STRING, TIMESTAMP, conform, struct
from tidelog.session import prepare
from tidelog.sinks.batches import Batch, batch_schema, create_dataset, read_batches, stream_id, write_batch

RAISED, CLEARED = "raised", "cleared"
STATES = struct(topic=STRING, last_at=TIMESTAMP, silent=BOOLEAN, at=TIMESTAMP)
ALERTS = struct(topic=STRING, state=STRING, last_at=TIMESTAMP, at=TIMESTAMP)


def with_heartbeat(changes: DataFrame, rows_per_second: int = 1) -> DataFrame:
    """``topic`` and ``timestamp`` of a stream of records, and the time now as a record without a topic."""
    beats = changes.sparkSession.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return changes.select("topic", "timestamp").unionByName(beats.select(F.lit(None).cast("string").alias("topic"), "timestamp"))


class SilenceAlerts:
    """Alerts of silent topics and the topics' states, stored under ``path``."""

    def __init__(self, spark: SparkSession, path: str, after: str = STALE_AFTER):
        self.spark = prepare(spark)
        self.path = path.rstrip("/")
        self.after = after

    def create(self) -> "SilenceAlerts":
        create_dataset(self.spark, f"{self.path}/states", batch_schema(STATES))
        create_dataset(self.spark, f"{self.path}/alerts", batch_schema(ALERTS))
        return self

    def alerts(self) -> DataFrame:
        """Everything raised and cleared so far."""
        return read_batches(self.spark, f"{self.path}/alerts", ALERTS)

    def states(self, batch: Batch) -> DataFrame:
        """The topics' states before a batch. Only the newest earlier batch is read."""
        stored = read_batches(self.spark, f"{self.path}/states", STATES).filter((F.col("stream") == batch.stream) & (F.col("batch") < batch.number))
        last = stored.agg(F.max("batch")).first()[0]
        return stored.filter(F.col("batch") == (-1 if last is None else last)).select(*STATES.names)

    def open(self) -> DataFrame:
        """Topics that are silent as of the last batch: ``topic, last_at``."""
        stored = read_batches(self.spark, f"{self.path}/states", STATES)
        last = stored.groupBy("stream").agg(F.max("batch").alias("batch"))
        return stored.join(last, ["stream", "batch"]).filter("silent").select("topic", "last_at")

    def process(self, records: DataFrame, batch: Batch) -> None:
        """Take the records of one batch in: raise and clear what they change."""
        prepare(records.sparkSession)
        # Reduced per task first; from here on there are as many rows as topics.
        newest = records.groupBy("topic").agg(F.max("timestamp").alias("seen_at")).persist()
        try:
            before = self.states(batch)
            topics = newest.filter(F.col("topic").isNotNull() & F.col("seen_at").isNotNull())
            both = before.drop("at").withColumnRenamed("last_at", "_last").join(topics, "topic", "full")
            clock = F.greatest(newest.agg(F.max("seen_at")).scalar(), before.agg(F.max("at")).scalar())
            state = both.select(
                "topic", F.greatest("_last", "seen_at").alias("last_at"), F.coalesce("silent", F.lit(False)).alias("_was"), clock.alias("at")
            ).withColumn("silent", F.col("last_at") < F.col("at") - F.expr(self.after))
            changed = state.filter(F.col("silent") != F.col("_was"))
            alerts = changed.withColumn("state", F.when(F.col("silent"), RAISED).otherwise(CLEARED))
            write_batch(conform(alerts, ALERTS).coalesce(1), f"{self.path}/alerts", batch)
            write_batch(conform(state, STATES).coalesce(1), f"{self.path}/states", batch)
        finally:
            newest.unpersist()

    def start(self, changes: DataFrame, checkpoint: str, every: str | None = "1 minute") -> StreamingQuery:
        """Watch a stream of records (or ``with_heartbeat`` of one); ``every=None`` works off what is there and stops."""
        self.create()
        stream = stream_id(checkpoint)

        def run(records: DataFrame, number: int) -> None:
            self.process(records, Batch(stream, number))

        writer = changes.select("topic", "timestamp").writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()
