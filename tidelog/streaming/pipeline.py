"""The continuous job: change records in, target tables, metrics and quarantine out."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType

from tidelog.functions.times import ms_to_timestamp
from tidelog.operators import classify as C
from tidelog.operators import lag, merge, project, quarantine
from tidelog.operators.parse import document_fields_read, parse_changes
from tidelog.schemas import BATCH_AUDIT, BIGINT, BOOLEAN, COUNTERS, DRIFT, INT, METRICS, QUARANTINE, STRING, conform, struct
from tidelog.session import prepare
from tidelog.sinks.batches import Batch, create_dataset, batch_schema, read_batches, stream_id, write_batch
from tidelog.sinks.daily_counts import DailyCounts
from tidelog.sinks.target_table import TargetTable
from tidelog.sinks.topics import Produce
from tidelog.sources.changes import deliver_once
from tidelog.spec import ORDERS, SPECS, CollectionSpec, Target, fields_read


def column_types(spark: SparkSession, spec: CollectionSpec, target: Target) -> dict[str, DataType]:
    """Type of each column of a target, from its expressions over the spec's fields."""
    fields = ", ".join(f"`{name}` {kind}" for name, kind in ((target.key, "string"), *spec.fields))
    columns = spark.createDataFrame([], fields).select(*project.target_columns(target))
    return {field.name: field.dataType for field in columns.schema}


class Store:
    """The datasets of one pipeline under a common root.

    ``specs`` are the collections whose targets it holds; ``extra`` are further targets of the first.
    ``order_by`` is the order in which changes of a key replace each other (operators.merge); it holds for
    the whole life of a store.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        specs: CollectionSpec | Sequence[CollectionSpec] = ORDERS,
        extra: Sequence[Target] = (),
        buckets: int = 64,
        order_by: str = merge.ARRIVAL,
    ):
        self.spark = prepare(spark)
        self.order_by = order_by
        self.root = root.rstrip("/")
        self.specs = [specs] if isinstance(specs, CollectionSpec) else list(specs)
        self.targets = {spec.name: [*spec.targets, *(extra if i == 0 else ())] for i, spec in enumerate(self.specs)}
        self.tables = {
            t.table: TargetTable(spark, f"{self.root}/{t.database}/{t.table}", t, column_types(spark, spec, t), buckets, order_by)
            for spec in self.specs
            for t in self.targets[spec.name]
        }
        if len(self.tables) < sum(map(len, self.targets.values())):
            raise ValueError("two targets of a store share a table name")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def create(self) -> "Store":
        for table in self.tables.values():
            table.create()
        create_dataset(self.spark, self.path("metrics"), batch_schema(METRICS).add("day", "date"))
        create_dataset(self.spark, self.path("dlq"), batch_schema(QUARANTINE))
        create_dataset(self.spark, self.path("counters"), batch_schema(COUNTERS))
        create_dataset(self.spark, self.path("offset_audit"), batch_schema(BATCH_AUDIT))
        create_dataset(self.spark, self.path("drift"), batch_schema(DRIFT))
        create_dataset(self.spark, self.path("dead"), batch_schema(QUARANTINE), "json")
        return self

    def metrics(self) -> DataFrame:
        """Metric rows; filters on ``day`` prune partitions."""
        schema = batch_schema(METRICS).add("day", "date")
        return self.spark.read.schema(schema).parquet(self.path("metrics"))

    def quarantine(self) -> DataFrame:
        return read_batches(self.spark, self.path("dlq"), QUARANTINE)

    def dead_letters(self) -> DataFrame:
        return read_batches(self.spark, self.path("dead"), QUARANTINE, "json")

    def counters(self) -> DataFrame:
        return read_batches(self.spark, self.path("counters"), COUNTERS)

    def offset_audit(self) -> DataFrame:
        return read_batches(self.spark, self.path("offset_audit"), BATCH_AUDIT)

    def complete_batches(self) -> dict[str, int]:
        """The last batch of each stream that is written as a whole; a row per stream."""
        audited = self.offset_audit().filter(F.col("unbroken").isNotNull()).groupBy("stream").agg(F.max("batch").alias("batch"))
        return {row["stream"]: row["batch"] for row in audited.collect()}

    def kpis(self, as_of: Column | None = None) -> DataFrame:
        """The latency report (operators.kpi). Only metric rows of batches since the last report are counted anew."""
        counts = DailyCounts(self.spark, self.path("kpi"))
        counts.refresh(self.metrics(), self.complete_batches())
        return counts.kpis(self.metrics(), as_of)

    def drift(self) -> DataFrame:
        return read_batches(self.spark, self.path("drift"), DRIFT)

    def lag(self, log: DataFrame) -> DataFrame:
        """Offset positions of the job against the log it reads (operators.lag)."""
        return lag.lag_of_job(self.offset_audit(), log)

    def compact(self, forget_deleted_before_ms: int | None = None) -> None:
        """Fold the batches of every table; offsets that are known without a gap need one first write each."""
        complete = lag.complete_positions(self.offset_audit())
        for table in self.tables.values():
            table.compact(forget_deleted_before_ms, complete)


_DISPOSITIONS = (C.SKIPPED_TOMBSTONE, C.SKIPPED_NO_ROUTE, C.QUARANTINED, C.UPSERT, C.DELETE)


def process_batch(
    records: DataFrame,
    store: Store,
    batch: Batch,
    specs: Sequence[CollectionSpec] = SPECS,
    unbroken: bool = False,
    quarantine_to: Produce | None = None,
) -> None:
    """Apply one batch of change records to every dataset of the store.

    The records are parsed once and kept for the writers below. Targets come
    first and the offset audit last, so an audited position is a written one.
    Each write is idempotent per batch: Spark repeats a batch until all of it
    went through.

    ``unbroken`` vouches that each partition's records in the batch follow each
    other without a gap, as those of the Kafka source do; else the offsets tell.
    ``quarantine_to`` takes what is queued as messages of the quarantine topic
    as well, such as ``sinks.topics.to_kafka``.
    """
    # Spark turns adaptive execution off in the session of a stream. This one
    # keeps no state, and without it every write makes a file per shuffle partition.
    prepare(records.sparkSession)
    nowhere = {spec.name for spec in specs if spec.targets} - set(store.targets)
    if nowhere:
        raise ValueError(f"collections with targets, but not in the store: {sorted(nowhere)}")
    received_ms = int(time.time() * 1000)
    events = C.classify(parse_changes(records, F.lit(received_ms), specs), specs)
    # Raw bytes are needed again only for rejected records, documents only for what their collection does not know.
    rejected, accepted = F.col("disposition") == C.QUARANTINED, F.col("disposition") == C.UPSERT
    kept = {name: F.when(rejected, F.col(name)) for name in ("key", "value")}
    events = events.withColumns({**kept, "extra": F.when(accepted, C.extra_fields(specs))})
    events = events.withColumn("extra", F.when(F.cardinality("extra") > 0, F.to_variant_object("extra")))
    # Texts that no target reads any more, the judged numbers among them, are not kept.
    read = {name for spec in specs if spec.targets for name, kind in spec.fields if kind != "double"}
    judged = [f"f_{name}" for name in document_fields_read(specs) if name not in read]
    events = events.drop("document", "document_text", "headers", "timestamp", *judged).persist()
    try:
        tests = {name: F.col("disposition") == name for name in _DISPOSITIONS} | {"drifted": F.col("extra").isNotNull()}
        # A row per topic partition, like the offsets a query's driver holds anyway.
        summary = lag.batch_summary(events, tests).collect()
        count = {name: sum(row[name] for row in summary) for name in tests}
        broken = [] if unbroken else [(row["topic"], row["partition"]) for row in summary if not row["unbroken"]]
        for spec in store.specs:
            _write_targets(events, store, spec, batch, broken, len(summary))
        writes = [lambda: _write_counters(store, batch, count)]
        if count[C.UPSERT] + count[C.DELETE]:
            writes.append(lambda: _write_metrics(events, store, batch, received_ms))
        if count["drifted"]:
            drift = conform(events.filter(F.col("extra").isNotNull()), DRIFT)
            writes.append(lambda: write_batch(drift, store.path("drift"), batch))
        if count[C.QUARANTINED]:
            records_out = quarantine.quarantine_records(events)
            queued = conform(records_out.filter(F.col("destination") == quarantine.QUEUED), QUARANTINE)
            writes.append(lambda: write_batch(queued, store.path("dlq"), batch))
            writes.append(lambda: write_batch(quarantine.dead_letters(records_out), store.path("dead"), batch, fmt="json"))
            if quarantine_to:
                writes.append(lambda: quarantine_to(quarantine.quarantine_messages(records_out), batch))
        _together(store.spark, *writes)
        _write_audit(store, batch, [(row["topic"], row["partition"], row["committed"], row["low"], unbroken or row["unbroken"]) for row in summary])
    finally:
        events.unpersist()


def _write_counters(store: Store, batch: Batch, count: dict[str, int]) -> None:
    rows = [(name, count[name]) for name in _DISPOSITIONS if count[name]]
    write_batch(store.spark.createDataFrame(rows, COUNTERS).coalesce(1), store.path("counters"), batch)


def _write_audit(store: Store, batch: Batch, positions: list[tuple]) -> None:
    columns = struct(topic=STRING, partition=INT, committed=BIGINT, low=BIGINT, unbroken=BOOLEAN)
    found = store.spark.createDataFrame(positions, columns).coalesce(1)
    write_batch(lag.audit_rows(found, F.current_timestamp(), schema=BATCH_AUDIT), store.path("offset_audit"), batch)


def _write_targets(events: DataFrame, store: Store, spec: CollectionSpec, batch: Batch, broken: list[tuple], partitions: int) -> None:
    """Append the states of one collection to its tables. One shuffle of its events serves all; the states are small."""
    targets = store.targets[spec.name]
    if not targets:
        return
    gaps: bool | Column = len(broken) == partitions if broken else False
    if broken and not gaps:
        gaps = F.lit(False)
        for topic in {topic for topic, _ in broken}:
            gaps = gaps | ((F.col("topic") == topic) & F.col("partition").isin([p for t, p in broken if t == topic]))
    applied = project.document_fields(events, spec)
    states = merge.collapse(applied, fields_read(*targets), key=spec.key, gaps=gaps, order=store.order_by).persist()
    try:
        if len(targets) > 1:
            states.count()
        _together(store.spark, *(lambda t=store.tables[target.table]: t.append(states, batch) for target in targets))
    finally:
        states.unpersist()


def _together(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """Run independent write jobs at the same time; the first failure is raised."""
    with ThreadPoolExecutor(len(writes)) as pool:
        for job in [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]:
            job.result()


def _write_metrics(events: DataFrame, store: Store, batch: Batch, received_ms: int) -> None:
    """Timing rows, one per routed event, received and stored as a batch. They never stop the pipeline."""
    routed = events.filter(F.col("disposition").isin(C.UPSERT, C.DELETE))
    stored_ms = F.lit(int(time.time() * 1000))
    rows = project.metric_rows(routed, F.lit(received_ms), stored_ms, ms_to_timestamp(stored_ms))
    rows = conform(rows.withColumn("success", F.lit(True)), METRICS).withColumn("day", F.to_date("recorded_at"))
    try:
        write_batch(rows, store.path("metrics"), batch, by=("day",))
    except Exception as failure:  # noqa: BLE001 - reported, never fatal
        print(f"metrics of batch {batch.number} not written: {failure}")


def start(
    changes: DataFrame,
    store: Store,
    checkpoint: str,
    specs: Sequence[CollectionSpec] = SPECS,
    every: str | None = "1 second",
    unbroken: bool = False,
    once_within: str | None = None,
    quarantine_to: Produce | None = None,
) -> StreamingQuery:
    """Start the job on a streaming DataFrame of change records.

    ``every=None`` works off what is there and stops. Offsets are committed to
    the checkpoint only after a batch was written or quarantined as a whole. A
    full replay, a skip or a reset is a new checkpoint with other starting
    offsets (streaming.reset). ``unbroken`` and ``quarantine_to`` are those of
    ``process_batch``; set the first for Kafka. ``once_within`` lets a record that is delivered again within
    that time through only once (sources.changes.deliver_once).
    """
    store.create()
    stream = stream_id(checkpoint)
    if once_within:
        changes = deliver_once(changes, once_within)

    def run(records: DataFrame, number: int) -> None:
        process_batch(records, store, Batch(stream, number), specs, unbroken, quarantine_to)

    writer = changes.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()
