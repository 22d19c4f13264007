"""The registered queries: every operator over the whole derived logs.

Each query takes ``(spark, sf_dir)``. The expected result of each is stated as
SQL over the base tables in :mod:`tidelog.plans.expected`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelog.functions.times import timestamp_to_ms
from tidelog.functions.rows import one_row
from tidelog.operators import classify as C
from tidelog.operators import drift, items, kpi, lag, merge, project, quarantine, verify
from tidelog.operators.parse import parse_changes
from tidelog.schemas import METRICS, conform
from tidelog.session import shared_folder
from tidelog.sinks.batches import Batch, batch_schema, write_batch
from tidelog.sinks.daily_counts import DailyCounts
from tidelog.sources import fixtures as X
from tidelog.sources.changes import read_from_files, stream_from_files, stream_quarantine_files, stream_replay_log
from tidelog.spec import LINE_ITEMS, ORDERS, ORDERS_FLAT, SPECS, TRANSACTIONS, fields_read
from tidelog.streaming.alerts import SilenceAlerts
from tidelog.streaming.pipeline import Store, start
from tidelog.streaming.replay import Replay, replay_until_settled, start_replay
from tidelog.streaming.reset import start_from

#: Row groups of a stored log before compression, a few times less on disk.
ROW_GROUP_BYTES = 4 << 20

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- shared steps ---------------------------------------------------------


def _order_log(spark: SparkSession, sf: str) -> DataFrame:
    """The order log, its texts built on all cores although the test tables are single files."""
    return X.order_log(spark, sf, partitions=spark.sparkContext.defaultParallelism)


def _store_log(log: DataFrame, path: str) -> None:
    """Store a log as files whose row groups are small: the tasks that parse a file read one or more of them each,
    and a file of one group keeps all but one of its tasks idle."""
    log.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)


def _order_events(spark: SparkSession, sf: str) -> DataFrame:
    return C.classify(parse_changes(_order_log(spark, sf)))


def _all_events(spark: SparkSession, sf: str) -> DataFrame:
    return C.classify(parse_changes(_order_log(spark, sf).unionByName(X.product_log(spark, sf))))


def _applied(spark: SparkSession, sf: str) -> DataFrame:
    return project.document_fields(_order_events(spark, sf))


def _once(events: DataFrame) -> DataFrame:
    """Without exact re-deliveries."""
    return events.dropDuplicates(["topic", "partition", "offset"])


def _in_ms(rows: DataFrame) -> DataFrame:
    """Timestamps as epoch milliseconds, which hash the same everywhere."""
    kinds = dict(rows.dtypes)
    return rows.select(
        *(timestamp_to_ms(F.col(c)).alias(f"{c}_ms") if kinds[c] == "timestamp" else F.col(c) for c in rows.columns)
    )


def _targets(spark: SparkSession, sf: str) -> list[DataFrame]:
    return merge.replay(_applied(spark, sf), ORDERS_FLAT, TRANSACTIONS)


def _orders_flat(spark: SparkSession, sf: str) -> DataFrame:
    return merge.replay(_applied(spark, sf), ORDERS_FLAT)[0]


def _newest(metrics: DataFrame) -> Column:
    return metrics.agg(F.max("recorded_at")).scalar()


# --- merge ----------------------------------------------------------------


@query
def orders_flat_final(spark, sf):
    return _in_ms(_orders_flat(spark, sf))


@query
def transactions_final(spark, sf):
    return _in_ms(merge.replay(_applied(spark, sf), TRANSACTIONS)[0])


@query
def merge_two_batches(spark, sf):
    """Two overlapping batches, the second one delivered twice, merged as states."""
    slot = F.col("offset") % 8
    batches = F.array_compact(F.array(F.when(slot <= 3, 1), F.when(slot >= 2, 2), F.when(slot >= 2, 3)))
    batched = _applied(spark, sf).withColumn("batch", F.explode(batches))
    states = merge.fold(merge.collapse(batched, ORDERS_FLAT.reads, apart=["batch"]), ORDERS_FLAT.reads)
    return _in_ms(merge.target_rows(merge.resolve(states, ORDERS_FLAT.reads), ORDERS_FLAT))


@query
def merge_interleaved_batches(spark, sf):
    """Three batches whose records lie between each other, folded one after the other: first writes and deletes of a key meet late."""
    path = shared_folder(spark, "interleaved")
    applied = _applied(spark, sf).withColumn("part", (F.col("offset") % 8 * 5 + F.floor(F.col("offset") / 8)) % 3)
    # Stored as batches are, so the log is parsed once for all of them.
    applied.write.partitionBy("part").parquet(path)
    stored, kept = spark.read.schema(applied.schema).parquet(path), None
    for part in range(3):
        states = merge.collapse(stored.filter(F.col("part") == part), ORDERS_FLAT.reads, gaps=True)
        kept = states if kept is None else merge.fold(kept.unionByName(states), ORDERS_FLAT.reads)
    return _in_ms(merge.target_rows(merge.resolve(kept, ORDERS_FLAT.reads), ORDERS_FLAT))


@query
def orders_by_source_time(spark, sf):
    """The order table when the time of the change at its source decides, not its arrival; in two batches that interleave."""
    halves = _applied(spark, sf).withColumn("batch", F.col("offset") % 2)
    states = merge.collapse(halves, ORDERS_FLAT.reads, apart=["batch"], order=merge.SOURCE_TIME)
    states = merge.fold(states, ORDERS_FLAT.reads, order=merge.SOURCE_TIME)
    return _in_ms(merge.target_rows(merge.resolve(states, ORDERS_FLAT.reads, order=merge.SOURCE_TIME), ORDERS_FLAT))


@query
def stream_orders_flat(spark, sf):
    """The continuous job over files of the log, in several micro-batches, then compacted."""
    root = shared_folder(spark, "stream")
    _store_log(_order_log(spark, sf), f"{root}/log")
    store = Store(spark, f"{root}/store", buckets=8)
    start(stream_from_files(spark, f"{root}/log", max_files=4), store, f"{root}/checkpoint", every=None).awaitTermination()
    store.tables["orders_flat"].compact()
    return _in_ms(store.tables["orders_flat"].read())


@query
def line_items_final(spark, sf):
    events = C.classify(parse_changes(X.item_log(spark, sf)))
    return items.line_items(merge.replay(project.document_fields(events), LINE_ITEMS)[0])


# --- parsing, validation, routing -------------------------------------------


@query
def parsed_event_counts(spark, sf):
    return _all_events(spark, sf).groupBy("collection", "op").agg(F.count("*").alias("n"))


@query
def disposition_counts(spark, sf):
    return C.count_dispositions(_all_events(spark, sf))


@query
def rejection_reasons(spark, sf):
    rejected = _all_events(spark, sf).filter(F.col("disposition") == C.QUARANTINED)
    return rejected.groupBy("collection", "error").agg(F.count("*").alias("n"))


@query
def drift_fields(spark, sf):
    """Unknown document fields per collection, with the events that carry them."""
    events = _once(
        _order_events(spark, sf)
        .filter(F.col("disposition") == C.UPSERT)
        .select("topic", "partition", "offset", "collection", "doc_id", C.extra_fields().alias("extra"))
    )
    drift = events.select("collection", "doc_id", F.explode("extra").alias("field", "value"))
    return drift.select("collection", "doc_id", "field", F.col("value").cast("string").alias("value"))


@query
def drift_metadata(spark, sf):
    """Drift kept as one JSON column per event."""
    events = _order_events(spark, sf).select("topic", "partition", "offset", "doc_id", "disposition", C.extra_fields().alias("extra"))
    kept = events.filter((F.col("disposition") == C.UPSERT) & (F.cardinality("extra") > 0))
    return _once(kept).select("doc_id", "offset", F.to_json("extra").alias("metadata"))


@query
def routed_rows(spark, sf):
    routed = C.routes(_order_events(spark, sf).select("collection", "disposition"))
    return routed.groupBy("db_target", "table", "is_delete").agg(F.count("*").alias("n"))


@query
def delete_keys(spark, sf):
    """Document ids of deletes and tombstones, which only the record key holds."""
    wanted = F.col("disposition").isNotNull() & F.col("op").isin("d", "tombstone")
    events = _order_events(spark, sf).filter(wanted)
    return events.select("op", "doc_id", "offset", "ts_ms")


@query
def coerced_types(spark, sf):
    """Values of every accepted event after unwrapping extended JSON."""
    events = _order_events(spark, sf).filter(F.col("disposition") == C.UPSERT)
    fields = events.select("topic", "partition", "offset", "doc_id", "f_customer_id", "n_total", "event_ms", "kafka_ts_ms")
    return _once(fields).select(
        "offset", "doc_id", F.col("f_customer_id").alias("customer_id"), F.col("n_total").alias("total"), "event_ms", "kafka_ts_ms"
    )


@query
def extreme_values(spark, sf):
    """Times and quantities at and beyond the limits of their types: rejected, or stored as they are."""
    events = C.classify(parse_changes(X.extreme_log(spark, sf)))
    flat, carts = merge.replay(project.document_fields(events), ORDERS_FLAT, LINE_ITEMS)
    stored = _in_ms(flat).select(F.col("order_id").alias("doc_id"), "updated_at_ms")
    bought = items.line_items(carts).select(F.col("order_id").alias("doc_id"), "qty")
    judged = events.select("doc_id", "disposition", "error")
    return judged.join(stored, "doc_id", "left").join(bought, "doc_id", "left")


@query
def product_rules(spark, sf):
    events = C.classify(parse_changes(X.product_log(spark, sf)))
    missing = F.concat_ws(",", C.missing_fields()).alias("missing")
    return events.select("doc_id", "disposition", missing)


@query
def dlq_records(spark, sf):
    events = _once(_order_events(spark, sf).filter(F.col("disposition") == C.QUARANTINED))
    records = quarantine.quarantine_records(events, F.col("timestamp"))
    return records.select(
        "source_topic", "source_partition", "source_offset", "error", "retry_count", "failed_at", "destination",
        "raw_key", "raw_value",
    )


@query
def retry_routing(spark, sf):
    events = _once(_order_events(spark, sf).filter(F.col("disposition") == C.QUARANTINED))
    records = quarantine.quarantine_records(events, F.col("timestamp"))
    return records.groupBy("destination", "retry_count").agg(F.count("*").alias("n"))


def _quarantine_log(spark, sf) -> DataFrame:
    """Rejected records as quarantine messages, all of them, whatever their retry count."""
    events = _once(_order_events(spark, sf).filter(F.col("disposition") == C.QUARANTINED))
    records = quarantine.quarantine_records(events, F.col("timestamp"))
    messages = records.withColumn("destination", F.lit(quarantine.QUEUED))
    position = messages.select("*", F.col("source_partition").alias("partition"), F.col("source_offset").alias("offset"))
    payload = F.to_json(F.struct(*quarantine.PAYLOAD), {"ignoreNullFields": "false"}).cast("binary")
    return position.select("partition", "offset", payload.alias("value"))


@query
def replay_plan(spark, sf):
    plan = quarantine.plan_replay(_quarantine_log(spark, sf))
    return plan.select(
        "partition", "offset", "action", "retry_count", "topic",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("raw_value"),
        F.element_at("headers", 1)["value"].cast("string").alias("retry_header"),
    )


@query
def replay_counts(spark, sf):
    return quarantine.count_actions(quarantine.plan_replay(_quarantine_log(spark, sf)))


@query
def replay_first_50(spark, sf):
    """Replay limited to the first messages in log order."""
    plan = quarantine.plan_replay(quarantine.first_messages(_quarantine_log(spark, sf), 50))
    return plan.select("partition", "offset", "action")


@query
def replay_odd_messages(spark, sf):
    """What becomes of quarantine messages that another producer wrote, undecodable ones among them."""
    plan = quarantine.plan_replay(X.foreign_quarantine(spark, sf))
    return plan.select("partition", "offset", "action", "retry_count", F.col("value").cast("string").alias("raw_value"))


@query
def stream_dlq_replay(spark, sf):
    """Quarantine dataset written by the continuous job, replayed as a stream; queued ones only."""
    root = shared_folder(spark, "replay")
    _store_log(_order_log(spark, sf), f"{root}/log")
    store = Store(spark, f"{root}/store", buckets=8)
    start(stream_from_files(spark, f"{root}/log"), store, f"{root}/checkpoint", every=None).awaitTermination()
    messages = stream_quarantine_files(spark, store.path("dlq"))
    start_replay(messages, f"{root}/out", f"{root}/replay-checkpoint").awaitTermination()
    counters = spark.read.parquet(f"{root}/out/replay_counters")
    return counters.groupBy("action").agg(F.sum("n").alias("n"))


@query
def stream_replay_until_dead(spark, sf):
    """The closed loop: rejected records are replayed into the job until each is written or dead.

    From the second round on the job no longer requires a customer, as if
    mended by then, so some of the records go through.
    """
    root = shared_folder(spark, "loop")
    _store_log(_order_log(spark, sf), f"{root}/log")
    store = Store(spark, f"{root}/store", buckets=8).create()
    replay = Replay(spark, f"{root}/replay").create()
    mended = replace(ORDERS, required=("status",))

    def job(number: int):
        changes = stream_from_files(spark, f"{root}/log").unionByName(stream_replay_log(spark, replay.log.path))
        specs = SPECS if number == 0 else (mended, *SPECS[1:])
        return start(changes, store, f"{root}/checkpoint", specs=specs, every=None)

    replay_until_settled(job, replay, stream_quarantine_files(spark, store.path("dlq")), f"{root}/replay-checkpoint")
    dead = store.dead_letters().unionByName(replay.dead_letters()).select("raw_key", F.lit("dead").alias("outcome"), "retry_count", "error")
    tried = F.element_at("headers", 1)["value"].cast("string").cast("int")
    sent = replay.log.read().groupBy(F.col("key").cast("string").alias("raw_key")).agg(F.max(tried).alias("retry_count"))
    written = sent.join(dead, "raw_key", "left_anti").select("raw_key", F.lit("written").alias("outcome"), "retry_count", F.lit(None).cast("string").alias("error"))
    stored = store.tables["orders_flat"].read().select(F.col("order_id"), F.col("status"))
    found = dead.unionByName(written).withColumn("order_id", F.regexp_extract("raw_key", "[0-9a-f]{24}", 0)).join(stored, "order_id", "left")
    return found.select("raw_key", "outcome", "retry_count", "error", F.when(F.col("outcome") == "written", F.col("status")).alias("status"))


# --- metrics --------------------------------------------------------------


@query
def stage_latencies(spark, sf):
    return _in_ms(X.event_metrics(spark, sf).drop("topic", "partition", "offset"))


@query
def kpi_summary(spark, sf):
    metrics = X.event_metrics(spark, sf)
    return kpi.kpis(metrics, _newest(metrics))


@query
def kpi_incremental(spark, sf):
    """The same report from counts per day, kept up to date as three batches of metric rows arrive."""
    root = shared_folder(spark, "kpi")
    rows = conform(X.event_metrics(spark, sf), METRICS).withColumn("day", F.to_date("recorded_at"))
    counts = DailyCounts(spark, f"{root}/counts")
    stored = spark.read.schema(batch_schema(METRICS).add("day", "date"))
    for n in range(3):
        write_batch(rows.filter(F.col("offset") % 3 == n), f"{root}/metrics", Batch("metrics", n), by=("day",))
        counts.refresh(stored.parquet(f"{root}/metrics"), {"metrics": n})
    return counts.kpis(stored.parquet(f"{root}/metrics"))


@query
def kpi_empty(spark, sf):
    """The same report over metrics newer than the newest: defaults only."""
    metrics = X.event_metrics(spark, sf)
    newest = _newest(metrics)
    return kpi.kpis(metrics.filter(F.col("recorded_at") > newest), newest)


@query
def throughput_windows(spark, sf):
    metrics = X.event_metrics(spark, sf)
    return kpi.throughput(metrics, _newest(metrics))


@query
def throughput_per_minute(spark, sf):
    return _in_ms(kpi.per_minute(X.event_metrics(spark, sf)).select("minute", "n"))


@query
def latency_last_100(spark, sf):
    return _in_ms(kpi.latency_series(X.event_metrics(spark, sf)))


@query
def recent_20(spark, sf):
    return kpi.recent_events(X.event_metrics(spark, sf))


# --- offsets, lag and queue -------------------------------------------------


@query
def log_positions(spark, sf):
    return lag.positions_of_log(_order_log(spark, sf).unionByName(X.product_log(spark, sf)))


@query
def lag_by_partition(spark, sf):
    return lag.sorted_lag(X.offset_positions(spark, sf))


@query
def lag_rollup(spark, sf):
    return lag.lag_rollup(X.offset_positions(spark, sf))


@query
def lag_alert(spark, sf):
    return lag.lag_alert(X.offset_positions(spark, sf), limit=149)


@query
def topic_progress(spark, sf):
    return lag.topic_progress(X.offset_positions(spark, sf))


@query
def queue_status(spark, sf):
    metrics = X.event_metrics(spark, sf)
    return lag.queue_status(X.offset_positions(spark, sf), metrics, _newest(metrics))


@query
def catch_up_eta(spark, sf):
    """Catch-up estimate per topic at the overall rate of the last five minutes."""
    metrics = X.event_metrics(spark, sf)
    rate = kpi.throughput(metrics, _newest(metrics)).select("tput_5m").scalar()
    lags = lag.lag_by_partition(X.offset_positions(spark, sf)).groupBy("topic").agg(F.sum("lag").alias("lag"))
    return lags.select("topic", "lag", lag.catch_up_seconds(F.col("lag"), rate / 5).alias("eta_seconds"))


@query
def topic_list(spark, sf):
    return lag.list_topics(_order_log(spark, sf).unionByName(X.product_log(spark, sf)))


@query
def stale_topics(spark, sf):
    """Topics silent for five minutes before the newest record of any topic."""
    records = _order_log(spark, sf).unionByName(X.product_log(spark, sf)).select("topic", "timestamp")
    return _in_ms(lag.stale_topics(records, records.agg(F.max("timestamp")).scalar()))


@query
def reset_offsets(spark, sf):
    """Starting offsets of a query that re-reads what is committed."""
    return lag.starting_offsets(X.offset_positions(spark, sf), "committed")


@query
def offset_audit(spark, sf):
    positions = _order_events(spark, sf).groupBy("topic", "partition").agg((F.max("offset") + 1).alias("committed"))
    return lag.audit_rows(positions, F.timestamp_millis(F.lit(1704067200123)))


@query
def pipeline_counters(spark, sf):
    """Consumed, written and rejected events, highest partition lag and mean latency in one row."""
    counts = C.count_dispositions(_order_events(spark, sf))
    events = counts.agg(
        F.sum("n").alias("consumed"),
        F.sum(F.when(F.col("disposition").isin(C.UPSERT, C.DELETE), F.col("n"))).alias("written"),
        F.sum(F.when(F.col("disposition") == C.QUARANTINED, F.col("n"))).alias("rejected"),
    )
    worst = lag.lag_by_partition(X.offset_positions(spark, sf)).agg(F.max("lag").alias("max_lag"))
    mean = X.event_metrics(spark, sf).agg(F.round(F.avg("e2e_lat_ms")).alias("avg_e2e_ms"))
    return one_row(events, worst, mean)


@query
def stream_lag(spark, sf):
    """Lag of the running job: it has read the files of the first four records of each order, the others wait."""
    root = shared_folder(spark, "lag")
    log = _order_log(spark, sf)
    _store_log(log.filter("offset % 8 <= 3"), f"{root}/log/first")
    store = Store(spark, f"{root}/store", buckets=8)
    start(stream_from_files(spark, f"{root}/log/*"), store, f"{root}/checkpoint", every=None).awaitTermination()
    _store_log(log.filter("offset % 8 > 3"), f"{root}/log/then")
    return lag.lag_by_partition(store.lag(read_from_files(spark, f"{root}/log/*")))


@query
def stream_reset(spark, sf):
    """The job started from the earliest and latest record and from an offset in the middle: where, and what it has read."""
    root = shared_folder(spark, "reset")
    _store_log(_order_log(spark, sf), f"{root}/log")
    log = read_from_files(spark, f"{root}/log")
    middle = log.agg(F.expr("(min(offset) + max(offset)) div 2")).first()[0]
    found = None
    for name, position in (("earliest", "earliest"), ("middle", middle), ("latest", "latest")):
        store = Store(spark, f"{root}/{name}", buckets=4)
        changes = stream_from_files(spark, f"{root}/log", max_files=8)
        start_from(position, changes, log, store, f"{root}/{name}-checkpoint", every=None).awaitTermination()
        audit = store.offset_audit()
        begun = audit.filter(F.col("stream").startswith("reset-")).select("partition", F.col("committed").alias("start"))
        reached = audit.groupBy("partition").agg(F.max("committed").alias("committed"))
        read = store.counters().agg(F.coalesce(F.sum("n"), F.lit(0)).alias("consumed")).scalar()
        rows = begun.join(reached, "partition").select(F.lit(name).alias("position"), "partition", "start", "committed", read.alias("consumed"))
        found = rows if found is None else found.unionByName(rows)
    return found


@query
def stream_deduplicated(spark, sf):
    """Counters of the job when the log is delivered twice, and a record passes once."""
    root = shared_folder(spark, "once")
    _store_log(_order_log(spark, sf), f"{root}/log/first")
    _store_log(_order_log(spark, sf).filter("offset % 3 = 0"), f"{root}/log/again")
    store = Store(spark, f"{root}/store", buckets=4)
    changes = stream_from_files(spark, f"{root}/log/*", max_files=8)
    start(changes, store, f"{root}/checkpoint", every=None, once_within="1 hour").awaitTermination()
    return store.counters().groupBy("disposition").agg(F.sum("n").alias("n"))


@query
def stream_stale_topics(spark, sf):
    """Topics that fell silent, from alerts raised while the stream was read."""
    root = shared_folder(spark, "alerts")
    _store_log(_order_log(spark, sf).unionByName(X.product_log(spark, sf)), f"{root}/log")
    alerts = SilenceAlerts(spark, f"{root}/alerts")
    alerts.start(stream_from_files(spark, f"{root}/log", max_files=8), f"{root}/checkpoint", every=None).awaitTermination()
    return _in_ms(alerts.open())


def _drift(spark, sf, purpose: str) -> DataFrame:
    return _stored(spark, sf, purpose).drift()


@query
def stream_drift(spark, sf):
    """Unknown document fields as the job has stored them."""
    return drift.drift_fields(_drift(spark, sf, "drift")).select("collection", "doc_id", "field", F.col("value").cast("string").alias("value"))


@query
def drift_types(spark, sf):
    """Events and type of each unknown field in the stored drift."""
    return drift.drift_types(_drift(spark, sf, "types")).select("collection", "field", "n", "type", "first_ms", "last_ms")


# --- verification ---------------------------------------------------------


@query
def count_parity(spark, sf):
    return verify.count_parity(X.live_orders(spark, sf), _orders_flat(spark, sf))


@query
def key_parity(spark, sf):
    """The source against a copy of the target that lacks some keys and has some of its own."""
    number = F.conv("order_id", 16, 10).cast("bigint")
    extra = F.concat(F.lit("extra-"), "order_id")
    # Both kinds of keys from one pass over the target.
    copied = F.array_compact(F.array(F.when(number % 101 != 0, F.col("order_id")), F.when(number % 103 == 0, extra)))
    target = _orders_flat(spark, sf).select(F.explode(copied).alias("order_id"))
    return verify.key_parity(X.live_orders(spark, sf), target, "order_id")


@query
def insert_visible(spark, sf):
    """Keys last written (not deleted) with a write time derived from their position."""
    path = shared_folder(spark, "visible")
    payload = [*fields_read(ORDERS_FLAT, TRANSACTIONS), "written_kafka_ms"]
    applied = _applied(spark, sf).withColumn("written_kafka_ms", F.col("kafka_ts_ms"))
    reduced = merge.resolve(merge.collapse(applied, payload), payload)
    # The log is reduced once and stored; the keys and both targets are read from that.
    reduced.write.parquet(path)
    written = spark.read.schema(reduced.schema).parquet(path)
    stored = F.col("written_kafka_ms") + (F.col("offset") * 37) % 2500
    analytics, finance = (merge.target_rows(written, target) for target in (ORDERS_FLAT, TRANSACTIONS))
    return verify.insert_visible(
        written,
        {"analytics": analytics, "finance": finance},
        "order_id",
        F.greatest(F.lit(0), stored - F.col("event_ms")),
    )


@query
def update_propagated(spark, sf):
    return verify.update_propagated(X.live_orders(spark, sf), _orders_flat(spark, sf), "order_id", "status")


@query
def delete_propagated(spark, sf):
    """Keys deleted for good, looked up in both targets; one reduction of the log serves all."""
    payload = fields_read(ORDERS_FLAT, TRANSACTIONS)
    resolved = merge.resolve(merge.collapse(_applied(spark, sf), payload), payload, keep_deleted=True)
    present = resolved.filter(~F.col("is_delete"))
    targets = {name: merge.target_rows(present, t) for name, t in (("analytics", ORDERS_FLAT), ("finance", TRANSACTIONS))}
    return verify.delete_propagated(resolved.filter("is_delete"), targets, "order_id")


@query
def duplicate_records(spark, sf):
    """Re-delivered records of the log."""
    return verify.duplicate_keys(_order_log(spark, sf), "topic", "partition", "offset")


@query
def duplicate_keys(spark, sf):
    """Keys that occur more than once in a copy of the target in which some rows were stored again.

    The log is applied twice first; that alone must make no duplicate.
    """
    delivered = _applied(spark, sf).withColumn("_delivery", F.explode(F.array(F.lit(1), F.lit(2))))
    twice = merge.replay(delivered, ORDERS_FLAT)[0].select("order_id")
    number = F.conv("order_id", 16, 10).cast("bigint")
    times = F.when(number % 107 == 0, 3).when(number % 101 == 0, 2).otherwise(1)
    return verify.duplicate_keys(twice.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), times))), "order_id")


@query
def table_counts(spark, sf):
    events = C.classify(parse_changes(X.item_log(spark, sf)))
    line_items = items.line_items(merge.replay(project.document_fields(events), LINE_ITEMS)[0])
    orders_flat, transactions = _targets(spark, sf)
    return verify.table_counts(
        {
            "analytics.orders_flat": orders_flat,
            "analytics.line_items": line_items,
            "finance.transactions": transactions,
        }
    )


def _stored(spark, sf, purpose: str) -> Store:
    """The order log through the continuous job into a fresh store."""
    root = shared_folder(spark, purpose)
    _store_log(_order_log(spark, sf), f"{root}/log")
    store = Store(spark, f"{root}/store", buckets=8)
    start(stream_from_files(spark, f"{root}/log", max_files=4), store, f"{root}/checkpoint", every=None).awaitTermination()
    return store


@query
def target_lookup(spark, sf):
    """Rows of the stored target found by their keys, after a compaction: the buckets of these keys alone are read."""
    table = _stored(spark, sf, "lookup").tables["orders_flat"]
    table.compact()
    return _in_ms(table.read([f"{k:024x}" for k in (1, 2, 3, 7, 10, 20, 33, 67, 97, 134)]))


@query
def target_rows_of_customers(spark, sf):
    """Rows of the stored target for the orders of some customers: the keys come from a table."""
    table = _stored(spark, sf, "customers").tables["orders_flat"]
    table.compact()
    wanted = X.table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    orders = X.table(spark, sf, "orders").join(wanted, "o_custkey", "left_semi")
    return _in_ms(table.read_joined(orders.select(F.expr(X.object_id("o_orderkey")).alias("order_id"))))


@query
def stream_two_collections(spark, sf):
    """Orders and customers through one job: each reaches its own table, under its own key and column names."""
    root = shared_folder(spark, "two")
    _store_log(_order_log(spark, sf).unionByName(X.customer_log(spark, sf)), f"{root}/log")
    store = Store(spark, f"{root}/store", (ORDERS, X.CUSTOMERS), buckets=4)
    changes = stream_from_files(spark, f"{root}/log", max_files=4)
    start(changes, store, f"{root}/checkpoint", specs=(*SPECS, X.CUSTOMERS), every=None).awaitTermination()
    orders = _in_ms(store.tables["orders_flat"].read())
    accounts = _in_ms(store.tables["accounts"].read())
    return orders.selectExpr("'orders' AS collection", "order_id AS key", "status AS label", "total AS amount", "updated_at_ms AS changed_ms").unionByName(
        accounts.selectExpr("'customers' AS collection", "account_key AS key", "label", "balance AS amount", "changed_at_ms AS changed_ms")
    )


@query
def stream_transactions(spark, sf):
    """The second target of the continuous job, read without a compaction."""
    return _in_ms(_stored(spark, sf, "transactions").tables["transactions"].read())
