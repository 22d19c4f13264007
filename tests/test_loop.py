"""The job in company: replay loop, reset, lag, drift, alerts, reports that do not rescan."""

import json
import random
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from records import PLAIN, TOPIC, TS, envelope, frame, key_of, numbered, record
from tidelog.operators import classify as C
from tidelog.operators import drift, kpi, lag, merge, project, quarantine
from tidelog.operators.parse import parse_changes
from tidelog.schemas import BATCH_AUDIT, CHANGE_RECORD
from tidelog.sinks.batches import Batch, stream_id
from tidelog.sinks.daily_counts import DailyCounts
from tidelog.sinks.topics import REPLAY_PARTITIONS, ReplayLog, kafka_messages, to_kafka
from tidelog.sources import fixtures as X
from tidelog.sources.changes import (
    deliver_once, quarantine_end, read_from_files, starting_at, stream_from_files, stream_quarantine_files, stream_replay_log,
)
from tidelog.spec import ORDERS_FLAT
from tidelog.streaming.alerts import CLEARED, RAISED, SilenceAlerts, with_heartbeat
from tidelog.streaming.pipeline import Store, process_batch, start
from tidelog.streaming.replay import Replay, replay_until_settled
from tidelog.streaming.reset import reset_offsets, start_from


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*(columns or sorted(df.columns))).collect()), key=repr)


def bad(n, retries=None):
    return record(f"not json {n}".encode(), key_of(f"{n:024x}"), offset=n, retries=retries)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"), buckets=2).create()


# --- replay -----------------------------------------------------------------


def test_replay_ends_with_the_batch_that_reaches_the_limit_and_resumes(spark, store, tmp_path):
    for n in range(3):
        process_batch(frame(spark, [bad(10 * n + i) for i in range(3)]).coalesce(1), store, Batch("s", n))
    messages = stream_quarantine_files(spark, store.path("dlq"), max_files=1)
    replay, checkpoint = Replay(spark, str(tmp_path / "replay")).create(), str(tmp_path / "checkpoint")
    first = replay.run(messages, checkpoint, limit=4)
    assert first == {quarantine.REPLAYED: replay.log.read().count()} and 4 <= first[quarantine.REPLAYED] <= 6
    assert replay.run(messages, checkpoint) == {quarantine.REPLAYED: 9 - first[quarantine.REPLAYED]}
    assert replay.log.read().count() == replay.counters().agg(F.sum("n")).first()[0] == 9


def test_a_failing_producer_is_no_limit(spark, store, tmp_path):
    process_batch(frame(spark, [bad(1)]), store, Batch("s", 0))

    def broken(messages, batch):
        raise OSError("broker away")

    replay = Replay(spark, str(tmp_path / "replay"), broken).create()
    messages, checkpoint = stream_quarantine_files(spark, store.path("dlq")), str(tmp_path / "checkpoint")
    with pytest.raises(Exception, match="broker away"):
        replay.run(messages, checkpoint, limit=5)
    assert replay.counters().count() == 0
    replay.produce = None
    assert replay.run(messages, checkpoint) == {quarantine.REPLAYED: 1}  # nothing was lost


def test_replay_may_begin_behind_what_is_stored(spark, store, tmp_path):
    process_batch(frame(spark, [bad(1)]), store, Batch("s", 0))
    process_batch(frame(spark, [bad(1)]), store, Batch("t", 0))
    end = quarantine_end(spark, store.path("dlq"))
    assert end == {"s": 0, "t": 0}
    messages = stream_quarantine_files(spark, store.path("dlq"), after=end)
    replay = Replay(spark, str(tmp_path / "replay")).create()
    assert replay.run(messages, str(tmp_path / "checkpoint")) in ({}, {quarantine.REPLAYED: 0})
    process_batch(frame(spark, [bad(2)]), store, Batch("s", 1))
    assert replay.run(messages, str(tmp_path / "checkpoint")) == {quarantine.REPLAYED: 1}


def test_replayed_positions(spark, tmp_path):
    """A message keeps its offset and moves one replay on; the same batch again changes nothing."""
    log = ReplayLog(spark, str(tmp_path / "log")).create()
    payload = {"source_topic": TOPIC, "source_partition": 3, "source_offset": 7, "error": "x", "retry_count": 1, "raw_value": "v", "raw_key": "k"}
    foreign = {"source_topic": TOPIC, "raw_value": "w"}
    values = spark.createDataFrame([(json.dumps(p).encode(),) for p in (payload, foreign)], "value binary")
    messages = quarantine.replay_messages(quarantine.plan_replay(values))
    for _ in range(2):
        log(messages, Batch("r", 0))
    got = {bytes(r["value"]).decode(): r for r in log.read().collect()}
    assert len(got) == log.read().count() == 2
    assert (got["v"]["partition"], got["v"]["offset"], bytes(got["v"]["key"])) == (3 + REPLAY_PARTITIONS, 7, b"k")
    assert bytes(got["v"]["headers"][0]["value"]) == b"2" and got["w"]["partition"] == REPLAY_PARTITIONS and got["w"]["offset"] >= 0
    assert kafka_messages(messages).columns == ["topic", "key", "value", "headers"]


def test_the_broker_gets_each_batch(spark, monkeypatch):
    """Without Spark's Kafka package: what is asked of the writer."""
    asked = {}
    from pyspark.sql import DataFrameWriter

    monkeypatch.setattr(DataFrameWriter, "format", lambda self, name: asked.update(format=name) or self)
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: asked.update(saved=True))
    monkeypatch.setattr(DataFrameWriter, "options", lambda self, **options: asked.update(options) or self)
    to_kafka("broker:9092", **{"kafka.acks": "all"})(frame(spark, [bad(1)]), Batch("s", 0))
    assert asked == {"format": "kafka", "kafka.bootstrap.servers": "broker:9092", "includeHeaders": "true", "kafka.acks": "all", "saved": True}


def test_queued_records_go_to_the_quarantine_topic(spark, store, tmp_path):
    """And its messages can be replayed as they are read from there."""
    path = str(tmp_path / "topic")
    produce = lambda messages, batch: messages.write.mode("append").parquet(path)
    process_batch(frame(spark, [bad(1), bad(2, retries=3), record(envelope("c", PLAIN), offset=5)]), store, Batch("s", 0), quarantine_to=produce)
    topic = spark.read.parquet(path)
    assert [r["topic"] for r in topic.collect()] == [quarantine.QUARANTINE_TOPIC]
    replay = Replay(spark, str(tmp_path / "replay")).create()
    messages = spark.readStream.schema(topic.schema).parquet(path)
    assert replay.run(messages, str(tmp_path / "checkpoint")) == {quarantine.REPLAYED: 1}
    assert [(r["topic"], r["offset"]) for r in replay.log.read().collect()] == [(TOPIC, 1)]


def test_loop_settles_all(spark, tmp_path):
    """Counts rise with each round; what is mended on the way is written, the rest is dead after the last retry."""
    root = str(tmp_path)
    delete = record(envelope("d"), key_of(f"{9:024x}"), offset=9)
    frame(spark, [bad(0), bad(1, 2), bad(2, 3), record(envelope("c", PLAIN), offset=5), delete]).write.parquet(f"{root}/log")
    store, replay = Store(spark, f"{root}/store", buckets=2).create(), Replay(spark, f"{root}/replay").create()

    def job(number):
        changes = stream_from_files(spark, f"{root}/log").unionByName(stream_replay_log(spark, replay.log.path))
        return start(changes, store, f"{root}/checkpoint", every=None)

    rounds = replay_until_settled(job, replay, stream_quarantine_files(spark, store.path("dlq")), f"{root}/replay-checkpoint")
    assert rounds == quarantine.MAX_RETRIES
    dead = {r["raw_value"]: (r["retry_count"], r["source_partition"] // REPLAY_PARTITIONS) for r in store.dead_letters().collect()}
    assert dead == {"not json 0": (3, 3), "not json 1": (3, 1), "not json 2": (3, 0)}
    assert replay.dead_letters().count() == 0 and store.tables["orders_flat"].read().count() == 1


# --- merge under any split ----------------------------------------------------


@pytest.mark.parametrize("order", [merge.ARRIVAL, merge.SOURCE_TIME])
def test_any_subsets_as_batches_of_the_job(spark, tmp_path, sf_dir, order):
    """Batches of records picked at random, compacted now and then: the tables of a whole replay, created_at included."""
    log = X.order_log(spark, sf_dir).filter("offset < 1500").persist()
    want = rows_of(merge.replay(project.document_fields(C.classify(parse_changes(log))), ORDERS_FLAT, order=order)[0])
    store = Store(spark, str(tmp_path / order), buckets=2, order_by=order).create()
    deal = F.pmod(F.xxhash64("offset", F.lit(order)), F.lit(3))
    for n, part in enumerate((2, 0, 1)):
        process_batch(log.filter(deal == part), store, Batch("s", n))
        if n % 2:
            store.compact()
    assert rows_of(store.tables["orders_flat"].read()) == want
    store.compact()
    assert rows_of(store.tables["orders_flat"].read()) == want


def test_compaction_needs_one_first_write_where_nothing_is_missing(spark, store):
    updates = [record(envelope("u", PLAIN, ts_ms=TS + n), offset=n) for n in range(40)]
    for n in range(4):
        process_batch(frame(spark, updates[n::4]), store, Batch("s", n))
    table = store.tables["orders_flat"]
    table.compact()
    assert table._base(1, 2).count() == 40  # every write may still turn out to be the first
    process_batch(frame(spark, updates), store, Batch("t", 0))
    store.compact()
    assert table._base(2, 2).count() == 1
    assert table.read().select(F.unix_millis("created_at")).first()[0] == TS


def test_untouched_keys_are_not_shuffled(spark, store, tmp_path):
    """After a compaction only what a later batch has touched is resolved; the rows are those of a whole replay."""
    n = 3000
    rows = [record(envelope("d" if i % 7 == 6 else "u", dict(PLAIN, _id=f"k{i % 900}"), ts_ms=TS + i), offset=i) for i in range(n)]
    process_batch(frame(spark, rows), store, Batch("s", 0))
    store.compact()
    late = [record(envelope("u", dict(PLAIN, _id="k3", city="new"), ts_ms=TS + n), offset=n), record(envelope("d", dict(PLAIN, _id="k5")), offset=n + 1)]
    process_batch(frame(spark, late), store, Batch("s", 1))
    table = store.tables["orders_flat"]
    every = frame(spark, rows + late)
    want = rows_of(merge.replay(project.document_fields(C.classify(parse_changes(every))), ORDERS_FLAT)[0])
    found = table.read()
    assert rows_of(found) == want
    assert rows_of(table.read(["k3", "k4", "k5"])) == [r for r in want if r[3] in ("k3", "k4", "k5")]
    assert rows_of(table.read_joined(spark.createDataFrame([("k3",), ("k5",), ("k8",), ("none",)], "order_id string"))) == [r for r in want if r[3] in ("k3", "k5", "k8")]
    table.read().write.parquet(str(tmp_path / "rows"))
    branches = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftAnti" in branches and branches.index("Union") < branches.index("Join LeftAnti") < branches.index("RepartitionByExpression")


def test_batch_summary(spark):
    at = lambda p, o: record(None, topic="t", partition=p, offset=o)
    held = [at(0, o) for o in (*range(32_760, 32_780), 32_770)] + [at(1, o) for o in (5, 7)] + [at(2, -1), at(2, 0), at(2, 1)]
    rows = lag.batch_summary(frame(spark, held), {"odd": F.col("offset") % 2 == 1}).collect()
    got = {r["partition"]: (r["low"], r["committed"], r["unbroken"], r["odd"]) for r in rows}
    assert got == {0: (32_760, 32_780, True, 10), 1: (5, 8, False, 2), 2: (-1, 2, True, 1)}


def test_complete_positions(spark):
    def audit(*rows):
        return spark.createDataFrame([("2024", "g", "t", p, high, low, whole) for p, low, high, whole in rows], BATCH_AUDIT)

    rows = audit(
        (0, 0, 10, True), (0, 10, 20, True), (0, 15, 25, True), (0, 30, 40, True),  # a gap before 30
        (1, 5, 10, True), (1, 10, 20, False), (1, 20, 30, True),  # the second is broken
        (2, 0, 9, False), (3, 0, 5, None), (3, 0, 7, True),
    )
    assert {r["partition"]: r["upto"] for r in lag.complete_positions(rows).collect()} == {0: 24, 1: 9, 3: 6}


# --- reset, lag, duplicates -----------------------------------------------------


@pytest.fixture(scope="module")
def log(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "orders")
    X.order_log(spark, sf_dir).repartition(4, "partition").sortWithinPartitions("partition", "offset").write.parquet(path)
    return path


def test_reset_is_audited_and_reads_again(spark, log, store, tmp_path):
    records = read_from_files(spark, log)
    first = store.lag(records)
    assert first.filter("committed IS NOT NULL").count() == 0
    start_from("latest", stream_from_files(spark, log), records, store, str(tmp_path / "a"), every=None).awaitTermination()
    assert store.counters().count() == 0 and lag.lag_by_partition(store.lag(records)).agg(F.sum("lag")).first()[0] == 0
    start_from("earliest", stream_from_files(spark, log), records, store, str(tmp_path / "b"), every=None).awaitTermination()
    assert store.counters().agg(F.sum("n")).first()[0] == records.count()
    audit = store.offset_audit()
    assert audit.filter(F.col("stream").startswith("reset-latest")).count() == audit.filter(F.col("stream").startswith("reset-earliest")).count() == 4
    assert store.complete_batches() == {stream_id(str(tmp_path / "b")): 0}
    assert reset_offsets(store, store.lag(records), 7) == {TOPIC: {str(p): 7 for p in range(4)}}
    assert reset_offsets(store, store.lag(records.limit(0)), "earliest") == {}


def test_a_start_offset_keeps_files_closed(spark, log):
    records = read_from_files(spark, log)
    some = starting_at(records, {TOPIC: {0: 1000, "1": 10**9}})
    want = records.filter("(partition = 0 AND offset >= 1000) OR partition > 1")
    assert rows_of(some, "partition", "offset") == rows_of(want, "partition", "offset")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = starting_at(records, {TOPIC: {0: 1000, "1": 10**9}})._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(offset,1000)" in pushed and "GreaterThanOrEqual(offset,1000000000)" in pushed
    assert starting_at(records, {}).count() == records.count()


def test_lag_follows_the_latest_audit(spark):
    rows = [(f"2024-01-0{d}", "g", "t", 0, at, None, None) for d, at in ((1, 50), (2, 10), (3, 30))]
    log = frame(spark, [record(None, topic="t", offset=o) for o in (5, 99)])
    assert rows_of(lag.lag_of_job(spark.createDataFrame(rows, BATCH_AUDIT), log)) == [(30, 100, 5, 0, "t")]


def test_a_record_passes_once(spark, tmp_path):
    """Over batches, however old the record; null keys and values too."""
    path = str(tmp_path / "log")
    old = record(None, offset=1, at_ms=0)
    for rows in ([bad(1), bad(2), bad(2)], [bad(2), old, bad(3)], [record(b"x", topic="other", offset=2), old]):
        frame(spark, rows).coalesce(1).write.mode("append").parquet(path)
    changes = deliver_once(stream_from_files(spark, path, max_files=1), "1 hour")
    out = changes.writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "checkpoint"))
    out.trigger(availableNow=True).start().awaitTermination()
    assert rows_of(spark.table("once"), "topic", "offset") == [("other", 2), (TOPIC, 1), (TOPIC, 2), (TOPIC, 3)]
    assert spark.table("once").columns == CHANGE_RECORD.names


# --- drift ------------------------------------------------------------------


def test_drift_is_stored_with_its_types(spark, store):
    docs = [dict(PLAIN, a=1, b={"c": [1, "x"]}), dict(PLAIN, a=2.5), dict(PLAIN, a="text", d=None), PLAIN]
    rows = [record(envelope("u", doc), offset=n) for n, doc in enumerate(docs)]
    unwanted = [record(envelope("u", {"_id": "x", "zzz": 1}), offset=8), record(envelope("d", dict(PLAIN, yyy=1)), offset=9)]
    process_batch(frame(spark, rows[:2] + unwanted), store, Batch("s", 0))
    process_batch(frame(spark, rows[1:]), store, Batch("s", 1))  # one record again
    fields = drift.drift_fields(store.drift()).select("offset", "field", F.to_json("value").alias("v"))
    assert rows_of(fields, "offset", "field", "v") == [(0, "a", "1"), (0, "b", '{"c":[1,"x"]}'), (1, "a", "2.5"), (2, "a", '"text"'), (2, "d", "null")]
    types = {r["field"]: (r["n"], r["type"]) for r in drift.drift_types(store.drift()).collect()}
    assert types == {"a": (3, "VARIANT"), "b": (1, "OBJECT<c: ARRAY<VARIANT>>"), "d": (1, "VOID")}


def test_a_batch_without_drift_or_rejects_writes_none(spark, store, tmp_path):
    process_batch(frame(spark, [record(envelope("c", PLAIN))]), store, Batch("s", 0))
    assert store.drift().count() == store.quarantine().count() == store.dead_letters().count() == 0
    assert not list((tmp_path / "store" / "drift").glob("stream=*")) and not list((tmp_path / "store" / "dlq").glob("stream=*"))
    process_batch(frame(spark, []), store, Batch("s", 1))
    assert store.counters().agg(F.sum("n")).first()[0] == 1


# --- alerts -----------------------------------------------------------------


def spoken(spark, *rows):
    """(topic, minute) pairs as records."""
    begin = datetime(2024, 1, 1, tzinfo=timezone.utc)
    return spark.createDataFrame([(t, None if m is None else begin + timedelta(minutes=m)) for t, m in rows], "topic string, timestamp timestamp")


def test_alerts_are_raised_and_cleared(spark, tmp_path):
    alerts = SilenceAlerts(spark, str(tmp_path / "alerts")).create()
    batches = [
        [("a", 0), ("b", 1), ("c", 1)],
        [("a", 6)],  # b and c are five minutes behind: not yet silent
        [("a", 7), ("c", 4), (None, 3), ("b", None)],  # c catches up, b is silent
        [("b", 7)],
        [(None, 30)],  # nobody speaks: the heartbeat alone raises all
        [("late", 2)],  # an unknown topic far behind
    ]
    for n, rows in enumerate(batches):
        for _ in range(2):  # each batch is repeated
            alerts.process(spoken(spark, *rows), Batch("s", n))
    got = rows_of(alerts.alerts(), "batch", "topic", "state")
    assert got == [(2, "b", RAISED), (3, "b", CLEARED), (4, "a", RAISED), (4, "b", RAISED), (4, "c", RAISED), (5, "late", RAISED)]
    assert rows_of(alerts.open().select("topic")) == [("a",), ("b",), ("c",), ("late",)]


def test_stream_and_batch_agree_on_silence(spark, tmp_path):
    draw = random.Random(4)
    rows = [(draw.choice("abcdef"), draw.randrange(0, 60)) for _ in range(120)]
    for n in range(6):
        spoken(spark, *rows[n::6]).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    changes = spark.readStream.schema("topic string, timestamp timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))
    alerts = SilenceAlerts(spark, str(tmp_path / "alerts"))
    alerts.start(changes, str(tmp_path / "checkpoint"), every=None).awaitTermination()
    records = spoken(spark, *rows)
    assert rows_of(alerts.open()) == rows_of(lag.stale_topics(records, records.agg(F.max("timestamp")).scalar()))


def test_heartbeat_adds_records_without_topic(spark, tmp_path):
    spoken(spark, ("a", 1)).write.parquet(str(tmp_path / "log"))
    changes = spark.readStream.schema("topic string, timestamp timestamp").parquet(str(tmp_path / "log"))
    assert with_heartbeat(changes).isStreaming and with_heartbeat(changes).columns == ["topic", "timestamp"]


# --- reports that do not rescan ---------------------------------------------------


def test_incremental_report_equals_the_whole(spark, log, store, tmp_path):
    records = read_from_files(spark, log)
    assert store.kpis().first()["total_docs"] == 0
    for n in range(3):
        process_batch(records.filter(f"partition % 3 = {n}"), store, Batch("s", n))
        as_of = F.lit(store.metrics().agg(F.max("recorded_at")).first()[0])
        assert store.kpis().first().asDict() == kpi.kpis(store.metrics(), as_of).first().asDict()
    assert store.kpis().first()["total_docs"] == store.metrics().count()


def test_only_new_batches_are_counted(spark, store):
    for n in range(3):
        process_batch(numbered(spark, [record(envelope("c", PLAIN))] * (n + 1)), store, Batch("s", n))
    counts = DailyCounts(spark, store.path("kpi"))
    counts.refresh(store.metrics(), {"s": 1})
    pending = counts.pending(store.metrics(), {"s": 2})
    plan = pending._jdf.queryExecution().executedPlan().toString()
    assert "batch" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert {r["batch"] for r in pending.collect()} == {2}
    before = counts.read().agg(F.sum("n")).first()[0]
    counts.refresh(store.metrics(), {"s": 1})  # nothing new
    assert counts.read().agg(F.sum("n")).first()[0] == before == 3
    # A fold that failed before its commit is written again, not twice.
    kpi.daily_counts(pending).withColumn("fold", F.lit(2).cast("bigint")).write.mode("append").partitionBy("fold", "day").parquet(f"{counts.path}/counts")
    assert counts.read().agg(F.sum("n")).first()[0] == 3
    counts.refresh(store.metrics(), {"s": 2})
    assert counts.read().agg(F.sum("n")).first()[0] == 6


# --- progress of running queries ----------------------------------------------------


def test_progress_is_stored_while_a_query_runs(spark, log, store, tmp_path):
    from tidelog.streaming.progress import ProgressLog

    listener = ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(listener)
    try:
        query = start(stream_from_files(spark, log, max_files=2), store, str(tmp_path / "checkpoint"), every=None)
        query.awaitTermination()
        for _ in range(100):
            if listener.read().count() >= 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert {r["stream"] for r in listener.read().collect()} == {str(query.id)}
    assert listener.positions().count() == 0  # files have no partitions


def test_positions_by_the_latest_progress(spark, tmp_path):
    from tidelog.streaming.progress import ProgressLog

    listener = ProgressLog(spark, str(tmp_path / "progress"))
    listener.store("q", 0, "2024", [("kafka", '{"t":{"0":5,"1":9}}', '{"t":{"0":10,"1":9}}')])
    listener.store("q", 1, "2024", [("kafka", '{"t":{"0":3,"1":9}}', '{"t":{"0":12,"1":9}}')])  # after a reset
    listener.store("q", 1, "2024", [("kafka", {"t": {"0": 3, "1": 9}}, {"t": {"0": 12, "1": 9}})])
    listener.store("r", 0, "2024", [("kafka", None, '{"u":{"0":4}}'), ("files", '{"logOffset":3}', None)])
    got = {(r["topic"], r["partition"]): (r["committed"], r["lag"]) for r in lag.lag_by_partition(listener.positions()).collect()}
    assert got == {("t", 0): (3, 9), ("t", 1): (9, 0), ("u", 0): (0, 4)}
