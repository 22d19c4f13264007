"""Texts that are composed or read per record stand where Spark compiles them, and a batch keeps no text it does not need."""

import pytest
from pyspark.sql import functions as F

from records import PLAIN, envelope, numbered, record
from tidelog.operators.parse import parse_changes
from tidelog.sources import fixtures as X
from tidelog.streaming import pipeline


def lines(frame, word):
    return [line for line in frame._jdf.queryExecution().optimizedPlan().toString().splitlines() if word in line]


@pytest.mark.parametrize("log", [X.order_log, X.item_log, X.customer_log])
def test_record_texts_are_composed_behind_the_generator(spark, sf_dir, log):
    (generate,) = lines(log(spark, sf_dir), "Generate explode")
    assert "concat" not in generate


def test_json_is_read_from_a_column(spark):
    rows = [record(envelope("c", PLAIN)), record(b"\xff\xfe"), record(None, key=b'{"id":"k"}')]
    events = parse_changes(numbered(spark, rows)).select("offset", "doc_id", "parse_error")
    found = lines(events, "from_json(")
    assert found and not [line for line in found if "isValid" in line or "is_valid_utf8" in line]
    assert [(r["doc_id"], r["parse_error"] is None) for r in events.orderBy("offset").collect()] == [("abc", True), ("", False), ("k", True)]


def test_a_batch_keeps_the_texts_its_targets_read(spark, tmp_path, monkeypatch):
    kept, summary = [], pipeline.lag.batch_summary
    monkeypatch.setattr(pipeline.lag, "batch_summary", lambda events, tests: kept.append(events.columns) or summary(events, tests))
    store = pipeline.Store(spark, str(tmp_path / "store"), buckets=1).create()
    rows = [record(envelope("c", PLAIN)), record(envelope("c", {**PLAIN, "_id": "bad", "total": "abc"}), key=b"{}")]
    pipeline.process_batch(numbered(spark, rows), store, pipeline.Batch("s", 0))
    assert {c for c in kept[0] if c.startswith(("f_", "n_"))} == {"f_customer_id", "f_status", "f_city", "f_items", "n_total"}
    assert [(r["order_id"], r["total"]) for r in store.tables["orders_flat"].read().collect()] == [("abc", 10.0)]
    assert store.quarantine().select(F.col("error")).first()[0] == "transform_failed: total"
