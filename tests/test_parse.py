"""Behaviours of parsing, validation and disposition, all cases as rows of one DataFrame."""

import json

import pytest
from pyspark.sql import functions as F

from records import ORDER, PLAIN, TS, envelope, key_of, numbered, record
from tidelog.operators import classify as C
from tidelog.operators import merge, project
from tidelog.operators.parse import ERROR_AFTER, ERROR_ENVELOPE, ERROR_NUMBER, parse_changes
from tidelog.spec import ORDERS_FLAT, TRANSACTIONS

INGEST = 1750000000123


def raw(**fields):
    return json.dumps({"ts_ms": TS, "source": {}, **fields}).encode()


def without(doc, *names):
    return {k: v for k, v in doc.items() if k not in names}


# name -> (record, expected columns)
CASES = {
    "insert": (record(envelope("c", ORDER)), dict(op="c", collection="orders", doc_id="a" * 24, ts_ms=TS, disposition="upsert", f_customer_id="cust-001", n_total=99.99)),
    "update": (record(envelope("u", dict(ORDER, status="SHIPPED"))), dict(op="u", f_status="SHIPPED", disposition="upsert")),
    "snapshot": (record(envelope("r", ORDER)), dict(op="r", disposition="upsert")),
    "delete": (record(envelope("d"), key_of("b" * 24)), dict(op="d", doc_id="b" * 24, disposition="delete", document=None)),
    "delete without key": (record(envelope("d")), dict(doc_id="", disposition="delete")),
    "delete bad key bytes": (record(envelope("d"), b"\xff\xfe broken"), dict(doc_id="", disposition="delete")),
    "delete plain key": (record(envelope("d"), b'{"id": "plain-string-id"}'), dict(doc_id="plain-string-id")),
    "delete quoted key": (record(envelope("d"), b'{"id": "\\"quoted\\""}'), dict(doc_id="quoted")),
    "delete numeric key": (record(envelope("d"), b'{"id": "{\\"$numberLong\\": \\"42\\"}"}'), dict(doc_id="42")),
    "delete key no id": (record(envelope("d"), b'{"x": 1}'), dict(doc_id="")),
    "delete key not json": (record(envelope("d"), b"oops"), dict(doc_id="")),
    "delete with document": (record(envelope("d", PLAIN), key_of("k")), dict(doc_id="abc", disposition="delete")),
    "tombstone": (record(None, key_of("c" * 24)), dict(op="tombstone", doc_id="c" * 24, ts_ms=0, document=None, disposition="skipped_tombstone", doc_size_bytes=0)),
    "tombstone no key": (record(None), dict(op="tombstone", doc_id="")),
    "tombstone products": (record(None, topic="poc.mydb.products"), dict(op="tombstone", collection="products")),
    "not json": (record(b"not-valid-json"), dict(disposition="dlq", error=ERROR_ENVELOPE)),
    "empty value": (record(b""), dict(disposition="dlq", error=ERROR_ENVELOPE)),
    "bad utf8": (record(b'{"op":"c\xff"}'), dict(disposition="dlq", error=ERROR_ENVELOPE)),
    "array envelope": (record(b"[1]"), dict(disposition="dlq", error=ERROR_ENVELOPE)),
    "null envelope": (record(b"null"), dict(disposition="dlq", error=ERROR_ENVELOPE)),
    "two values": (record(b'{"op":"c"} {"op":"c"}'), dict(disposition="dlq", error=ERROR_ENVELOPE)),
    "two values comma": (record(b'{"op":"c"},{"op":"c"}'), dict(disposition="dlq", error=ERROR_ENVELOPE)),
    "early close": (record(b'{"op":"c"}] x'), dict(disposition="dlq", error=ERROR_ENVELOPE)),
    "single quotes": (record(b"{'op':'c'}"), dict(disposition="dlq", error=ERROR_ENVELOPE)),
    "broken after": (record(raw(op="c", after="{broken json")), dict(disposition="dlq", error=ERROR_AFTER)),
    "after list": (record(raw(op="c", after="[1]")), dict(disposition="dlq", error=ERROR_AFTER)),
    "after number": (record(raw(op="c", after=5)), dict(disposition="dlq", error=ERROR_AFTER)),
    "after empty text": (record(raw(op="c", after="")), dict(disposition="dlq", error=ERROR_AFTER)),
    "after object": (record(envelope("c", ORDER, stringified=False)), dict(disposition="upsert", doc_id="a" * 24, n_total=99.99)),
    "no dots": (record(envelope("c", ORDER), topic="orders"), dict(collection="orders", disposition="upsert")),
    "empty topic": (record(envelope("c", PLAIN), topic=""), dict(collection="", disposition="skipped_no_route")),
    "unknown op": (record(raw(op="x", after=None)), dict(op="unknown", disposition="dlq", error="schema_validation_failed")),
    "empty op": (record(raw(op="", after=None)), dict(op="unknown", disposition="dlq")),
    "missing op": (record(raw(after=json.dumps(PLAIN))), dict(op="unknown", disposition="skipped_no_route")),
    "numeric op": (record(raw(op=5, after=json.dumps(PLAIN))), dict(op="unknown", disposition="skipped_no_route")),
    "ts null": (record(envelope("c", PLAIN, ts_ms=None)), dict(ts_ms=0, event_ms=INGEST, disposition="upsert")),
    "ts zero": (record(envelope("c", PLAIN, ts_ms=0)), dict(ts_ms=0, event_ms=INGEST)),
    "ts missing": (record(json.dumps({"op": "c", "after": json.dumps(PLAIN)}).encode()), dict(ts_ms=0, event_ms=INGEST)),
    "ts fraction": (record(envelope("c", PLAIN, ts_ms=1.5)), dict(disposition="dlq", error="transform_failed: ts_ms")),
    "insert after null": (record(envelope("c"), key_of("aabbcc")), dict(doc_id="", document=None, disposition="dlq", error="schema_validation_failed")),
    "empty document": (record(envelope("c", {})), dict(disposition="dlq", error="schema_validation_failed")),
    "no customer": (record(envelope("c", without(PLAIN, "customer_id"))), dict(disposition="dlq", error="schema_validation_failed")),
    "null customer": (record(envelope("c", dict(PLAIN, customer_id=None))), dict(disposition="dlq", error="schema_validation_failed")),
    "no status": (record(envelope("c", without(PLAIN, "status"))), dict(disposition="dlq", error="schema_validation_failed")),
    "empty status": (record(envelope("c", dict(PLAIN, status=""))), dict(disposition="upsert", f_status="")),
    "no city": (record(envelope("c", without(PLAIN, "city"))), dict(disposition="upsert", f_city=None)),
    "total text": (record(envelope("c", dict(PLAIN, total="19.99"))), dict(n_total=19.99, disposition="upsert")),
    "total int": (record(envelope("c", dict(PLAIN, total=50))), dict(n_total=50.0)),
    "total null": (record(envelope("c", dict(PLAIN, total=None))), dict(n_total=None, disposition="upsert")),
    "total negative": (record(envelope("c", dict(PLAIN, total=-5.0))), dict(n_total=-5.0)),
    "total large": (record(envelope("c", dict(PLAIN, total=999999999.99))), dict(n_total=999999999.99)),
    "total decimal": (record(envelope("c", dict(PLAIN, total={"$numberDecimal": "12.50"}))), dict(n_total=12.5)),
    "total long": (record(envelope("c", dict(PLAIN, total={"$numberLong": "42"}))), dict(n_total=42.0)),
    "total decimal point first": (record(envelope("c", dict(PLAIN, total={"$numberDecimal": "-.5"}))), dict(n_total=-0.5, disposition="upsert")),
    "total decimal point last": (record(envelope("c", dict(PLAIN, total={"$numberDecimal": " 7. "}))), dict(n_total=7.0)),
    "total decimal plus": (record(envelope("c", dict(PLAIN, total={"$numberDecimal": "+012.5"}))), dict(n_total=12.5)),
    "total long plus": (record(envelope("c", dict(PLAIN, total={"$numberLong": "+5"}))), dict(n_total=5.0)),
    "total infinite": (record(envelope("c", dict(PLAIN, total={"$numberDecimal": "-Infinity"}))), dict(n_total=float("-inf"), disposition="upsert")),
    "bad decimal": (record(envelope("c", dict(PLAIN, total={"$numberDecimal": "+-5"}))), dict(disposition="dlq", error=ERROR_NUMBER)),
    "bad decimal point": (record(envelope("c", dict(PLAIN, total={"$numberDecimal": "."}))), dict(disposition="dlq", error=ERROR_NUMBER)),
    "total bad text": (record(envelope("c", dict(PLAIN, total="abc"))), dict(disposition="dlq", error="transform_failed: total")),
    "total java suffix": (record(envelope("c", dict(PLAIN, total="12d"))), dict(disposition="dlq", error="transform_failed: total")),
    "total list": (record(envelope("c", dict(PLAIN, total=[1]))), dict(disposition="dlq", error="transform_failed: total")),
    "bad long": (record(envelope("c", dict(PLAIN, total={"$numberLong": "4x"}))), dict(disposition="dlq", error=ERROR_NUMBER)),
    "bad int fraction": (record(envelope("c", dict(PLAIN, n={"$numberInt": "1.5"}))), dict(disposition="dlq", error=ERROR_NUMBER)),
    "missing id": (record(envelope("c", without(PLAIN, "_id"))), dict(doc_id="", disposition="dlq", error="transform_failed: _id")),
    "null id": (record(envelope("c", dict(PLAIN, _id=None))), dict(doc_id="", disposition="dlq")),
    "numeric id": (record(envelope("c", dict(PLAIN, _id={"$numberInt": "7"}))), dict(doc_id="7", disposition="upsert")),
    "products": (record(envelope("c", {"_id": "p", "sku": "s", "price": 1}), topic="poc.mydb.products"), dict(disposition="skipped_no_route")),
    "products no price": (record(envelope("c", {"_id": "p", "sku": "s"}), topic="poc.mydb.products"), dict(disposition="dlq", error="schema_validation_failed")),
    "products delete": (record(envelope("d"), key_of("p"), topic="poc.mydb.products"), dict(disposition="skipped_no_route")),
    "unknown collection": (record(envelope("c", {"_id": "x"}), topic="poc.mydb.shipments"), dict(disposition="skipped_no_route")),
    "repeated key": (record(b'{"op":"c","ts_ms":5,"after":"{\\"_id\\":\\"a\\",\\"customer_id\\":\\"1\\",\\"customer_id\\":\\"2\\",\\"status\\":\\"s\\"}"}'), dict(f_customer_id="2", ts_ms=5, disposition="upsert")),
    "retry header": (record(envelope("c", PLAIN), retries=2), dict(retry_count=2)),
    "no headers": (record(envelope("c", PLAIN)), dict(retry_count=0)),
}


@pytest.fixture(scope="module")
def outcomes(spark):
    records = numbered(spark, [r for r, _ in CASES.values()])
    events = C.classify(parse_changes(records, F.lit(INGEST)))
    return {r["offset"]: r.asDict() for r in events.withColumn("document", F.col("document").cast("string")).collect()}


@pytest.mark.parametrize("name", CASES)
def test_case(outcomes, name):
    got = outcomes[list(CASES).index(name)]
    want = CASES[name][1]
    assert {k: got[k] for k in want} == want


COERCED = {
    '{"a":{"$oid":"abc"}}': '{"a":"abc"}',
    '{"a":{"$date":1706000000000}}': '{"a":1706000000000}',
    '{"a":{"$date":{"$numberLong":"1706000000000"}}}': '{"a":1706000000000}',
    '{"a":{"$date":1706000000000.0}}': '{"a":1706000000000}',
    '{"a":{"$date":"not-a-number"}}': '{"a":"not-a-number"}',
    '{"a":{"$numberDecimal":"9.99"}}': '{"a":9.99}',
    '{"a":{"$numberInt":"-7"}}': '{"a":-7}',
    '{"a":{"$numberLong":"007"}}': '{"a":7}',
    '{"a":{"$oid":"abc","extra":1}}': '{"a":{"$oid":"abc","extra":1}}',
    '{"a":[{"$oid":"aaa"},{ "$oid" : "bbb" }]}': '{"a":["aaa","bbb"]}',
    '{"m":{"c":{"$date":1000000},"n":{"$numberInt":"5"}},"t":[{"$oid":"b"}]}': '{"m":{"c":1000000,"n":5},"t":["b"]}',
    '{"a":"{\\"$oid\\":\\"x\\"}"}': '{"a":"{\\"$oid\\":\\"x\\"}"}',
    '{"a":"hello","b":42}': '{"a":"hello","b":42}',
}


def test_coercion(spark):
    rows = [record(raw(op="c", after=text)) for text in COERCED]
    events = parse_changes(numbered(spark, rows)).select("offset", F.col("document").cast("string").alias("d")).collect()
    got = {r["offset"]: r["d"] for r in events}
    assert [json.loads(got[i]) for i in range(len(rows))] == [json.loads(w) for w in COERCED.values()]


@pytest.mark.parametrize("text", ['{"a":{"$numberLong":"1"}2}', '{"a":5{"$oid":"x"}}', '{{"$oid":"k"}:1}'])
def test_coercion_keeps_broken_json_broken(spark, text):
    event = parse_changes(numbered(spark, [record(raw(op="c", after=text))])).first()
    assert event["parse_error"] == ERROR_AFTER


def test_long_strings_and_deep_documents_are_whole(spark):
    doc = dict(PLAIN, note='x"\\' * 100000, deep=json.loads("[" * 60 + "]" * 60), tag={"$oid": "q\\\"" * 5000})
    event = parse_changes(numbered(spark, [record(envelope("c", doc))])).select(
        F.col("document").cast("string").alias("d"), "doc_size_bytes"
    ).first()
    got = json.loads(event["d"])
    assert got["note"] == doc["note"] and got["deep"] == doc["deep"] and got["tag"] == doc["tag"]["$oid"]
    assert event["doc_size_bytes"] == len(envelope("c", doc))


def test_drift(spark):
    rows = [
        record(envelope("c", dict(PLAIN, field_a="x", field_b=1, field_c={"z": None}))),
        record(envelope("c", PLAIN)),
        record(envelope("c", {"_id": "s", "qty": 1}), topic="poc.mydb.shipments"),
        record(envelope("d"), key_of("x")),
    ]
    events = C.classify(parse_changes(numbered(spark, rows)))
    extra = events.select("offset", F.array_sort(F.map_keys(C.extra_fields())).alias("k")).collect()
    assert {r["offset"]: r["k"] for r in extra} == {
        0: ["field_a", "field_b", "field_c"],
        1: [],
        2: ["_id", "qty"],
        3: None,
    }


def test_missing_fields(spark):
    rows = [record(envelope("c", {"_id": "x", "city": "Y"})), record(envelope("c", PLAIN))]
    got = C.classify(parse_changes(numbered(spark, rows))).select("offset", C.missing_fields().alias("m")).collect()
    assert {r["offset"]: r["m"] for r in got} == {0: ["customer_id", "status"], 1: []}


def test_routes(spark):
    rows = [record(envelope(op, PLAIN)) for op in "cru"] + [record(envelope("d"), key_of("gone")), record(None)]
    routed = C.routes(C.classify(parse_changes(numbered(spark, rows))))
    got = sorted((r["offset"], r["db_target"], r["table"], r["is_delete"]) for r in routed.collect())
    assert got == sorted(
        (i, db, t, i == 3)
        for i in range(4)
        for db, t in (("analytics", "orders_flat"), ("finance", "transactions"))
    )


def test_target_rows(spark):
    applied = project.document_fields(C.classify(parse_changes(numbered(spark, [record(envelope("c", PLAIN))]))))
    flat, transactions = merge.replay(applied, ORDERS_FLAT, TRANSACTIONS)
    row = flat.withColumn("ms", F.unix_millis("created_at")).first()
    assert (row["order_id"], row["customer_id"], row["city"], row["total"], row["ms"]) == ("abc", "c1", "X", 10.0, TS)
    row = transactions.withColumn("ms", F.unix_millis("recorded_at")).first()
    assert (row["txn_id"], row["order_id"], row["amount"], row["status"], row["ms"]) == ("txn-abc", "abc", 10.0, "PENDING", TS)
    assert flat.columns == ["order_id", "customer_id", "status", "city", "total", "created_at", "updated_at"]
    assert transactions.columns == ["order_id", "txn_id", "amount", "status", "recorded_at"]


def test_plan_parses_once(spark):
    """Filters on the outcome must not pull the JSON work into the scan a second time."""
    applied = project.document_fields(C.classify(parse_changes(numbered(spark, [record(envelope("c", PLAIN))]))))
    flat = merge.replay(applied.filter(F.col("order_id") != "q"), ORDERS_FLAT)[0]
    plan = flat._jdf.queryExecution().executedPlan().toString()
    # envelope, document, key envelope, key id
    assert plan.count("from_json(") <= 4
    assert "parse_json" not in plan
