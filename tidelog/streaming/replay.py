"""Replay of quarantined messages to their source topics, once or until nothing is left to replay."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators import quarantine
from tidelog.schemas import BIGINT, QUARANTINE, STRING, struct
from tidelog.session import prepare
from tidelog.sinks.batches import Batch, batch_schema, create_dataset, read_batches, stream_id, write_batch
from tidelog.sinks.topics import Produce, ReplayLog

ACTIONS = struct(action=STRING, n=BIGINT)


class LimitReached(Exception):
    """Ends a replay before it begins another batch."""


def replay_batch(messages: DataFrame, root: str, batch: Batch, produce: Produce | None = None) -> dict[str, int]:
    """Produce one batch of messages, or store them as ``dead``; returns and stores the number of each action.

    ``produce`` takes the messages (sinks.topics); without one they go to the
    log of files ``replayed``. The counters come last: a batch that has them
    was worked off as a whole.
    """
    spark = prepare(messages.sparkSession)
    produce = produce or ReplayLog(spark, f"{root}/replayed")
    plan = quarantine.plan_replay(messages).persist()
    try:
        # One row per action.
        counts = {row["action"]: row["n"] for row in quarantine.count_actions(plan).collect()}
        if counts.get(quarantine.REPLAYED):
            produce(quarantine.replay_messages(plan), batch)
        if counts.get(quarantine.DEAD):
            write_batch(quarantine.replay_dead_letters(plan), f"{root}/dead", batch, fmt="json")
        write_batch(spark.createDataFrame(sorted(counts.items()), ACTIONS).coalesce(1), f"{root}/replay_counters", batch)
        return counts
    finally:
        plan.unpersist()


def start_replay(
    messages: DataFrame, root: str, checkpoint: str, limit: int = 0, produce: Produce | None = None, done: dict[str, int] | None = None
) -> StreamingQuery:
    """Work off the quarantine stream and stop; a kept checkpoint resumes where it left off.

    A new checkpoint starts over from the first message, or from where the
    source begins (sources.changes.stream_quarantine_files). With a ``limit``
    the query fails with ``LimitReached`` instead of beginning another batch
    once so many messages were replayed; what it has not begun stays queued.
    ``done`` collects the number of each action.
    """
    stream, done = stream_id(checkpoint), {} if done is None else done

    def run(batch_messages: DataFrame, number: int) -> None:
        if limit and done.get(quarantine.REPLAYED, 0) >= limit:
            raise LimitReached
        for action, n in replay_batch(batch_messages, root, Batch(stream, number), produce).items():
            done[action] = done.get(action, 0) + n

    writer = messages.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


class Replay:
    """A replay with its datasets under ``root``: ``replayed``, ``dead`` and ``replay_counters``."""

    def __init__(self, spark: SparkSession, root: str, produce: Produce | None = None):
        self.spark = prepare(spark)
        self.root = root.rstrip("/")
        self.log = ReplayLog(spark, f"{self.root}/replayed")
        self.produce = produce

    def create(self) -> "Replay":
        self.log.create()
        create_dataset(self.spark, f"{self.root}/dead", batch_schema(QUARANTINE), "json")
        create_dataset(self.spark, f"{self.root}/replay_counters", batch_schema(ACTIONS))
        return self

    def dead_letters(self) -> DataFrame:
        return read_batches(self.spark, f"{self.root}/dead", QUARANTINE, "json")

    def counters(self) -> DataFrame:
        return read_batches(self.spark, f"{self.root}/replay_counters", ACTIONS)

    def run(self, messages: DataFrame, checkpoint: str, limit: int = 0) -> dict[str, int]:
        """Work off the stream, wait, and return the number of each action.

        With a ``limit`` the run ends with the batch that reaches it, as the
        original looks at its limit after each poll. The source's ``max_files``
        keeps batches small.
        """
        done: dict[str, int] = {}
        try:
            start_replay(messages, self.root, checkpoint, limit, self.produce, done).awaitTermination()
        except StreamingQueryException:
            if not limit or done.get(quarantine.REPLAYED, 0) < limit:
                raise
        return done


def replay_until_settled(start_job: Callable[[int], StreamingQuery], replay: Replay, messages: DataFrame, checkpoint: str) -> int:
    """Run the job and the replay in turn until nothing is queued any more; returns the rounds it took.

    ``start_job(round)`` starts the continuous job over the source log and the
    replay log, to stop when it has read what is there. Every round raises the
    count of each message still queued, so after the last retry all of them are
    written or dead: the retries that are allowed bound the rounds.
    """
    for number in range(quarantine.MAX_RETRIES + 2):
        start_job(number).awaitTermination()
        if not replay.run(messages, checkpoint).get(quarantine.REPLAYED):
            return number
    raise RuntimeError("messages are still queued after the last retry")
