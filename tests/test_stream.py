"""The continuous job on file sources: stream equals batch, repeats change nothing."""

import json

import pytest
from pyspark.sql import functions as F

from records import PLAIN, TS, envelope, frame, key_of, record
from tidelog.operators import classify as C
from tidelog.operators import kpi, lag, merge, project, quarantine
from tidelog.operators.parse import parse_changes
from tidelog.sinks.batches import Batch, stream_id
from tidelog.sources import fixtures as X
from tidelog.sources.changes import read_from_files, stream_from_files, stream_quarantine_files
from tidelog.spec import LINE_ITEMS, ORDERS, ORDERS_FLAT, TRANSACTIONS
from tidelog.sinks.target_table import TargetTable
from tidelog.streaming.pipeline import Store, column_types, process_batch, start
from tidelog.streaming.replay import start_replay


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def log(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "orders")
    X.order_log(spark, sf_dir).repartition(3, "partition").write.parquet(path)
    return path


@pytest.fixture(scope="module")
def batch_result(spark, log):
    events = C.classify(parse_changes(read_from_files(spark, log)))
    return [rows_of(t) for t in merge.replay(project.document_fields(events), ORDERS_FLAT, TRANSACTIONS)]


@pytest.fixture(scope="module")
def streamed(spark, log, tmp_path_factory):
    root = tmp_path_factory.mktemp("stream")
    store = Store(spark, str(root / "store"), buckets=4)
    start(stream_from_files(spark, log, max_files=1), store, str(root / "checkpoint"), every=None).awaitTermination()
    return root, store


def test_stream_equals_batch(streamed, batch_result):
    _, store = streamed
    assert rows_of(store.tables["orders_flat"].read()) == batch_result[0]
    assert rows_of(store.tables["transactions"].read()) == batch_result[1]
    assert store.counters().select("batch").distinct().count() > 1


def test_counters_metrics_and_audit(spark, streamed, log):
    _, store = streamed
    want = {r["disposition"]: r["n"] for r in C.count_dispositions(C.classify(parse_changes(read_from_files(spark, log)))).collect()}
    got = {r["disposition"]: r["n"] for r in store.counters().groupBy("disposition").agg(F.sum("n").alias("n")).collect()}
    assert got == want
    applied = read_from_files(spark, log).count() - sum(
        n for d, n in want.items() if d not in ("upsert", "delete")
    )
    metrics = store.metrics()
    assert metrics.count() >= want["upsert"] + want["delete"] and metrics.count() <= applied
    assert metrics.filter("e2e_lat_ms < 0 OR NOT success").count() == 0
    assert kpi.kpis(metrics).first()["total_docs"] == metrics.count()
    audited = {
        (r["topic"], r["partition"]): r["c"]
        for r in store.offset_audit().groupBy("topic", "partition").agg(F.max("committed").alias("c")).collect()
    }
    assert audited == {(r["topic"], r["partition"]): r["high"] for r in lag.positions_of_log(read_from_files(spark, log)).collect()}
    assert store.quarantine().count() + store.dead_letters().count() == want["dlq"]
    assert store.dead_letters().filter("retry_count < 3").count() == 0
    assert store.quarantine().filter("retry_count >= 3").count() == 0


def test_finished_stream_has_nothing_more_to_do(spark, streamed, log, batch_result):
    root, store = streamed
    before = store.counters().count()
    start(stream_from_files(spark, log, max_files=1), store, str(root / "checkpoint"), every=None).awaitTermination()
    assert store.counters().count() == before


def test_repeated_batch_and_full_replay_change_nothing(spark, log, batch_result, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=4).create()
    records = read_from_files(spark, log)
    early, late = records.filter("offset % 8 <= 3"), records.filter("offset % 8 >= 3")
    process_batch(early, store, Batch("a", 0))
    process_batch(late, store, Batch("a", 1))
    process_batch(late, store, Batch("a", 1))  # the same batch again after a failure
    counted = store.counters().agg(F.sum("n")).first()[0]
    assert rows_of(store.tables["orders_flat"].read()) == batch_result[0]
    store.tables["orders_flat"].compact()
    process_batch(records, store, Batch("b", 0))  # everything again under a new checkpoint
    assert store.counters().filter("stream = 'a'").agg(F.sum("n")).first()[0] == counted
    assert rows_of(store.tables["orders_flat"].read()) == batch_result[0]
    assert rows_of(store.tables["transactions"].read()) == batch_result[1]


def test_compaction(spark, log, batch_result, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=4).create()
    store.create()  # an existing store stays as it is
    table = store.tables["orders_flat"]
    assert table.read().count() == 0
    records = read_from_files(spark, log)
    for n in range(3):
        process_batch(records.filter(f"partition % 3 = {n}"), store, Batch("s", n))
        table.compact()
    table.compact()  # nothing new: no further version
    assert table._committed() == (3, {"s": 2}, 4)
    assert rows_of(table.read()) == batch_result[0]
    table.expire()
    assert rows_of(table.read()) == batch_result[0]
    assert table._all_changes().count() == 0
    process_batch(records, store, Batch("t", 0))
    assert rows_of(table.read()) == batch_result[0]
    wider = TargetTable(spark, table.path, ORDERS_FLAT, column_types(spark, ORDERS, ORDERS_FLAT), buckets=7)
    wider.compact()  # another number of buckets from here on
    assert rows_of(table.read()) == batch_result[0]
    some = [r[0] for r in table.read().select("order_id").limit(2).collect()]
    found = table.read(some)
    assert sorted(r["order_id"] for r in found.collect()) == sorted(some)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "bucket IN (" in plan or "bucket#" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_deleted_keys_are_remembered_until_forgotten(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=2).create()
    table = store.tables["orders_flat"]
    insert = record(envelope("c", PLAIN), key_of("abc"), offset=1)
    delete = record(envelope("d", PLAIN), key_of("abc"), offset=2)
    process_batch(frame(spark, [insert, delete]), store, Batch("s", 0))
    table.compact()
    process_batch(frame(spark, [insert]), store, Batch("s", 1))  # a late re-delivery
    assert table.read().count() == 0
    table.compact(forget_deleted_before_ms=TS + 1)
    assert table._base(2, 2).count() == 0


def test_first_seen_is_kept_across_batches(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=2).create()
    table = store.tables["orders_flat"]
    for i, ms in enumerate((TS, TS + 60000, TS + 30000)):
        process_batch(frame(spark, [record(envelope("u", PLAIN, ts_ms=ms), offset=i)]), store, Batch("s", i))
    row = table.read().select(F.unix_millis("created_at").alias("c"), F.unix_millis("updated_at").alias("u")).first()
    assert tuple(row) == (TS, TS + 30000)


def test_bad_record_does_not_stop_the_batch(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=2).create()
    rows = [record(b"oops", offset=0), record(envelope("c", PLAIN), offset=1), record(None, offset=2)]
    process_batch(frame(spark, rows), store, Batch("s", 0))
    assert store.tables["orders_flat"].read().count() == 1
    assert [r["raw_value"] for r in store.quarantine().collect()] == ["oops"]


def test_failing_metrics_are_not_fatal(spark, tmp_path, monkeypatch):
    from tidelog.streaming import pipeline

    real = pipeline.write_batch

    def failing(df, path, *args, **kwargs):
        if path.endswith("/metrics"):
            raise OSError("disk full")
        real(df, path, *args, **kwargs)

    monkeypatch.setattr(pipeline, "write_batch", failing)
    store = Store(spark, str(tmp_path / "store"), buckets=2).create()
    process_batch(frame(spark, [record(envelope("c", PLAIN))]), store, Batch("s", 0))
    assert store.tables["orders_flat"].read().count() == 1 and store.counters().count() == 1


def test_line_items_as_a_third_target(spark, tmp_path):
    from tidelog.operators.items import line_items

    store = Store(spark, str(tmp_path / "store"), ORDERS, extra=[LINE_ITEMS], buckets=2).create()
    first = dict(PLAIN, items=[{"sku": "a", "qty": 1, "unit_price": 2.0}, {"sku": "b", "qty": 1, "unit_price": 2.0}])
    second = dict(PLAIN, items=[{"sku": "c", "qty": 3, "unit_price": {"$numberDecimal": "4.5"}}, "x"])
    process_batch(frame(spark, [record(envelope("c", first), offset=0)]), store, Batch("s", 0))
    process_batch(frame(spark, [record(envelope("u", second), offset=1)]), store, Batch("s", 1))
    assert [tuple(r) for r in line_items(store.tables["line_items"].read()).collect()] == [("abc", "c", 3, 4.5)]


def test_dlq_replay_until_dead(spark, streamed, tmp_path):
    """Messages replay with a higher count, and end as dead letters when it is used up."""
    _, store = streamed
    root = str(tmp_path / "replay")
    messages = stream_quarantine_files(spark, store.path("dlq"))
    start_replay(messages, root, str(tmp_path / "checkpoint")).awaitTermination()
    replayed = spark.read.parquet(f"{root}/replayed")
    assert replayed.count() == store.quarantine().count()
    start_replay(messages, root, str(tmp_path / "checkpoint")).awaitTermination()
    assert spark.read.parquet(f"{root}/replayed").count() == replayed.count()  # resumed: nothing new

    again = replayed.select(
        "key", "value", "topic", F.lit(9).alias("partition"),
        F.monotonically_increasing_id().alias("offset"), F.current_timestamp().alias("timestamp"), "headers",
    )
    rejected = quarantine.quarantine_records(C.classify(parse_changes(again)))
    counts = {r["retry_count"] for r in rejected.select("retry_count").distinct().collect()}
    assert counts == {1, 2, 3}
    assert rejected.filter("(retry_count >= 3) != (destination = 'dead')").count() == 0


def test_stream_names_differ_by_checkpoint():
    assert stream_id("/a/b") == stream_id("/a/b/") != stream_id("/a/c")


def test_stored_formats(streamed):
    root, store = streamed
    lines = [line for f in (root / "store" / "dead").rglob("*.json") for line in f.read_text().splitlines()]
    assert lines and all(json.loads(line)["retry_count"] >= 3 for line in lines)
    assert list((root / "store" / "metrics").glob("day=*"))


def test_per_minute_stream(spark, streamed, tmp_path):
    _, store = streamed
    metrics = spark.readStream.schema(store.metrics().schema).parquet(store.path("metrics"))
    out = kpi.per_minute(metrics).writeStream.format("memory").queryName("per_minute").outputMode("complete")
    out.trigger(availableNow=True).start().awaitTermination()
    assert spark.table("per_minute").agg(F.sum("n")).first()[0] == store.metrics().count()


def test_extreme_times_do_not_poison_the_table(spark, tmp_path, sf_dir):
    """Times that no timestamp holds are quarantined; the largest that one holds are stored and read back."""
    from tidelog.sources.fixtures import extreme_log
    from tidelog.streaming.pipeline import Store, process_batch
    from tidelog.sinks.batches import Batch

    store = Store(spark, f"{tmp_path}/extreme", buckets=2).create()
    log = extreme_log(spark, sf_dir)
    process_batch(log, store, Batch("s", 0))
    stored = store.tables["orders_flat"].read().select(F.unix_millis("updated_at").alias("ms")).distinct().collect()
    assert {r["ms"] for r in stored} == {9223372036854775, -9223372036854775, 1704067200000}
    assert store.quarantine().count() == log.filter("offset % 6 < 2").count()
    assert store.metrics().agg(F.max("e2e_lat_ms")).first()[0] > 2**31


def test_a_routed_collection_needs_its_tables(spark, tmp_path, sf_dir):
    from tidelog.spec import SPECS, CollectionSpec, Target

    other = CollectionSpec("others", targets=(Target("x", "y", "k", (), (), "at"),))
    store = Store(spark, f"{tmp_path}/partial", buckets=2).create()
    with pytest.raises(ValueError, match="others"):
        process_batch(X.order_log(spark, sf_dir), store, Batch("s", 0), (*SPECS, other))
