"""Progress of running queries as a dataset: what they have committed, and what their topics hold."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidelog.operators import lag
from tidelog.schemas import STRING, struct
from tidelog.sinks.batches import Batch, batch_schema, create_dataset, read_batches, write_batch

PROGRESS = struct(at=STRING, description=STRING, end_offset=STRING, latest_offset=STRING)


class ProgressLog(StreamingQueryListener):
    """Stores each progress report under ``path``, a row per source: ``spark.streams.addListener(ProgressLog(spark, path))``.

    One small file per micro-batch of a query; a report of the same batch
    replaces the one before. A report that cannot be stored is said and left
    out: it must not stop the query.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        create_dataset(spark, path, batch_schema(PROGRESS))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        try:
            self.store(str(progress.id), progress.batchId, progress.timestamp, ((s.description, s.endOffset, s.latestOffset) for s in progress.sources))
        except Exception as failure:  # noqa: BLE001 - reported, never fatal
            print(f"progress of batch {progress.batchId} not stored: {failure}")

    def store(self, query: str, batch: int, at: str, sources: Iterable[tuple[str, object, object]]) -> None:
        rows = [(at, description, _text(end), _text(latest)) for description, end, latest in sources]
        write_batch(self.spark.createDataFrame(rows, PROGRESS).coalesce(1), self.path, Batch(query, batch))

    def read(self) -> DataFrame:
        return read_batches(self.spark, self.path, PROGRESS)

    def positions(self) -> DataFrame:
        """Offset positions (operators.lag) by the latest report of each query."""
        reports = self.read()
        last = reports.groupBy("stream").agg(F.max("batch").alias("batch"))
        return lag.positions_of_progress(reports.join(F.broadcast(last), ["stream", "batch"], "left_semi"))


def _text(offset: object) -> str | None:
    """Offsets come as JSON text, or parsed already."""
    return offset if offset is None or isinstance(offset, str) else json.dumps(offset)
