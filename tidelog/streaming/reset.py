"""Start the job somewhere else in its log: at the earliest or latest record, at what is committed, or at an offset."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators import lag
from tidelog.schemas import BATCH_AUDIT, OFFSETS, conform
from tidelog.sinks.batches import Batch, write_batch
from tidelog.sources.changes import starting_at
from tidelog.streaming.pipeline import Store, start

Offsets = dict[str, dict[str, int]]


def reset_offsets(store: Store, positions: DataFrame, position: str | int) -> Offsets:
    """Starting offsets (topic -> partition -> offset) for a new query, audited like committed ones.

    ``positions`` has the low, next and committed offsets per topic partition
    (``Store.lag``); ``position`` is ``earliest``, ``latest``, ``committed`` or
    an offset. Kafka takes them as JSON (``startingOffsets``), stored logs by
    ``starting_at``.
    """
    known = conform(positions, OFFSETS).persist()
    try:
        text = lag.starting_offsets(known, position).first()["starting_offsets"]
        offsets: Offsets = json.loads(text) if text else {}
        rows = [(topic, int(partition), at) for topic, parts in offsets.items() for partition, at in parts.items()]
        if rows:
            at = store.spark.createDataFrame(rows, "topic string, partition int, committed bigint").coalesce(1)
            audit = lag.audit_rows(at, F.current_timestamp(), schema=BATCH_AUDIT)
            write_batch(audit, store.path("offset_audit"), Batch(f"reset-{position}-{uuid.uuid4().hex[:8]}", 0))
        return offsets
    finally:
        known.unpersist()


def start_from(
    position: str | int, changes: DataFrame, log: DataFrame, store: Store, checkpoint: str, **options
) -> StreamingQuery:
    """Reset the job to ``position`` of its stored ``log`` and start it on ``changes`` with a new checkpoint.

    As in the original, the job must not be running meanwhile. Results do not
    depend on what is read again: the merge is idempotent.
    """
    store.create()
    offsets = reset_offsets(store, store.lag(log), position)
    return start(starting_at(changes, offsets), store, checkpoint, **options)
