"""Percentiles, lag, offsets, quarantine and verification helpers on small inputs."""

import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from records import PLAIN, envelope, key_of, numbered, record
from tidelog.functions.times import iso_text, latency
from tidelog.operators import classify as C
from tidelog.operators import items, kpi, lag, quarantine, verify
from tidelog.operators.parse import parse_changes
from tidelog.operators.percentiles import exact_percentiles
from tidelog.schemas import METRICS, OFFSETS
from tidelog.sources.changes import kafka_options, stream_from_kafka

POINTS = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}


@pytest.mark.parametrize("values", [[1, 2, 10], [5], [], [0, 2**31 - 1], "random", "negative"])
def test_percentiles_are_exact(spark, values):
    if values == "random":
        values = [random.Random(7).randrange(10**7) for _ in range(3000)]
    elif values == "negative":
        values = [-70000, -1, 0, 0, 65536, 65537]
    rows = spark.createDataFrame([(v,) for v in values] + [(None,)], "v INT")
    got = exact_percentiles(rows, "v", POINTS).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE t (v INTEGER)")
    con.executemany("INSERT INTO t VALUES (?)", [[v] for v in values] or [[None]])
    terms = ", ".join(f"percentile_cont({p}) WITHIN GROUP (ORDER BY v)" for p in POINTS.values())
    want = con.execute(f"SELECT {terms} FROM t").fetchall()[0]
    assert len(got) == 1
    for have, expected in zip(got[0], want):
        assert have == (None if expected is None else pytest.approx(expected, rel=1e-12))


def test_kpis_of_an_empty_table(spark):
    row = kpi.kpis(spark.createDataFrame([], METRICS)).first()
    assert all(v == 0 for v in row)


def test_latency_is_never_negative_nor_capped(spark):
    rows = spark.createDataFrame([(5, 3), (3, 5), (0, 10**12)], "a BIGINT, b BIGINT")
    assert [r[0] for r in rows.select(latency(F.col("a"), F.col("b"))).collect()] == [0, 2, 10**12]


def test_iso_text(spark):
    rows = spark.range(1).select(
        iso_text(F.timestamp_millis(F.lit(1706000000000))), iso_text(F.timestamp_micros(F.lit(1706000000000007)))
    )
    assert tuple(rows.first()) == ("2024-01-23T08:53:20+00:00", "2024-01-23T08:53:20.000007+00:00")


def test_lag_rules(spark):
    rows = [("a", 0, 5, 0, 10), ("a", 1, 20, 0, 10), ("b", 0, None, 0, 7), ("c", 0, -1001, 0, 0)]
    offsets = spark.createDataFrame(rows, OFFSETS)
    got = [(r["topic"], r["partition"], r["committed"], r["lag"]) for r in lag.sorted_lag(offsets).collect()]
    assert got == [("a", 0, 5, 5), ("a", 1, 20, 0), ("b", 0, 0, 7), ("c", 0, 0, 0)]
    progress = {r["topic"]: (r["consumed"], r["severity"]) for r in lag.topic_progress(offsets).collect()}
    assert progress == {"a": (1.0, "few"), "b": (0.0, "few"), "c": (1.0, "caught_up")}


def test_starting_offsets(spark):
    offsets = spark.createDataFrame([("a", 0, 5, 2, 10), ("a", 11, None, 1, 4), ("b", 0, 7, 7, 7)], OFFSETS)
    def of(position):
        return json.loads(lag.starting_offsets(offsets, position).first()[0])

    assert of("earliest") == {"a": {"0": 2, "11": 1}, "b": {"0": 7}}
    assert of("latest") == {"a": {"0": 10, "11": 4}, "b": {"0": 7}}
    assert of("committed") == {"a": {"0": 5, "11": 0}, "b": {"0": 7}}
    assert of(3) == {"a": {"0": 3, "11": 3}, "b": {"0": 3}}


def test_positions_of_progress(spark):
    reports = spark.createDataFrame(
        [('{"a":{"0":3}}', '{"a":{"0":9,"1":4}}'), ('{"a":{"0":5}}', '{"a":{"0":9,"1":4}}')],
        "end_offset STRING, latest_offset STRING",
    )
    got = {(r["topic"], r["partition"]): (r["committed"], r["high"]) for r in lag.positions_of_progress(reports).collect()}
    assert got == {("a", 0): (5, 9), ("a", 1): (None, 4)}


def test_quarantine_record(spark):
    rows = [
        record(b"bad \xff bytes", b"k\xff", retries=3),
        record(b"", None, retries=2),
        record(envelope("c", PLAIN)),
    ]
    events = C.classify(parse_changes(numbered(spark, rows)))
    records = quarantine.quarantine_records(events).orderBy("source_offset").collect()
    assert [(r["raw_value"], r["raw_key"], r["destination"]) for r in records] == [
        ("bad � bytes", "k�", "dead"),
        (None, None, "dlq"),
    ]
    message = quarantine.quarantine_messages(quarantine.quarantine_records(events)).first()
    payload = json.loads(message["value"])
    assert message["topic"] == "poc.dlq"
    assert list(payload)[:7] == [
        "source_topic", "source_partition", "source_offset", "error", "retry_count", "failed_at", "raw_value",
    ]
    assert payload["raw_value"] is None and payload["retry_count"] == 2


def test_replay_plan(spark):
    def message(**fields):
        return json.dumps(fields).encode()

    rows = [
        (0, message(source_topic="t", raw_value="v", retry_count=0, raw_key="k")),
        (1, message(source_topic="t", raw_value=None, retry_count="2")),
        (2, message(source_topic="t", raw_value="v", retry_count=3)),
        (3, message(source_topic="", raw_value="v")),
        (4, b"not json"),
        (5, message(raw_value="v")),
        (6, message(source_topic="t", raw_value="v")),
        (7, message(source_topic="t", raw_value="v", retry_count="x")),
    ]
    plan = quarantine.plan_replay(spark.createDataFrame(rows, "offset BIGINT, value BINARY"))
    got = {r["offset"]: (r["action"], r["retry_count"], bytes(r["value"]), r["key"]) for r in plan.collect()}
    assert got[0] == ("replayed", 1, b"v", bytearray(b"k"))
    assert got[1] == ("replayed", 3, b"", None)
    assert got[2][:2] == ("dead", 4)
    assert [got[i][0] for i in (3, 4, 5, 6, 7)] == ["skipped", "skipped", "skipped", "replayed", "skipped"]
    assert {r["action"]: r["n"] for r in quarantine.count_actions(plan).collect()} == {"replayed": 3, "dead": 1, "skipped": 4}
    produced = quarantine.replay_messages(plan)
    assert produced.columns == ["topic", "key", "value", "headers"] and produced.count() == 3


def test_replayed_delete_keeps_its_key(spark):
    """A rejected record carries its key through the quarantine and back."""
    rejected = record(b'{"op":"d","ts_ms":1.5}', key_of("abc"))
    events = C.classify(parse_changes(numbered(spark, [rejected])))
    messages = quarantine.quarantine_messages(quarantine.quarantine_records(events))
    back = quarantine.replay_messages(quarantine.plan_replay(messages)).first()
    assert bytes(back["key"]) == key_of("abc") and bytes(back["value"]) == rejected[1]


def test_line_items_skip_other_entries(spark):
    rows = [
        ("a", '[{"sku":"s","qty":2,"unit_price":1.5},"{text",5,null,[{"sku":"n"}],{"sku":"t"}]'),
        ("b", "[]"),
        ("c", None),
        ("d", '{"sku":"s"}'),
    ]
    got = items.line_items(spark.createDataFrame(rows, "order_id STRING, items STRING")).collect()
    assert [tuple(r) for r in got] == [("a", "s", 2, 1.5), ("a", "t", None, None)]


def test_parity_and_duplicates(spark):
    a = spark.createDataFrame([("1",), ("2",), ("3",)], "k STRING")
    b = spark.createDataFrame([("2",), ("3",), ("4",), ("4",)], "k STRING")
    assert tuple(verify.count_parity(a, b).first()) == (3, 4, 1, True)
    assert tuple(verify.count_parity(a, b, tolerance=0).first())[3] is False
    assert sorted(map(tuple, verify.key_parity(a, b.distinct(), "k").collect())) == [("1", "source"), ("4", "target")]
    assert [tuple(r) for r in verify.duplicate_keys(b, "k").collect()] == [("4", 2)]


def test_kafka_options():
    options = kafka_options("host:9092", max_per_trigger=1000, starting_offsets='{"t":{"0":5}}')
    assert options["startingOffsets"] == '{"t":{"0":5}}'
    assert options["maxOffsetsPerTrigger"] == "1000" and options["includeHeaders"] == "true"
    assert kafka_options("h")["startingOffsets"] == "earliest" and "maxOffsetsPerTrigger" not in kafka_options("h")


def test_kafka_source_needs_its_package(spark):
    with pytest.raises(Exception, match="kafka"):
        stream_from_kafka(spark, "localhost:1")
