"""Build change records for tests."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from tidelog.schemas import CHANGE_RECORD

TOPIC = "poc.mydb.orders"
TS = 1706000000000
ORDER = {
    "_id": {"$oid": "aaaaaaaaaaaaaaaaaaaaaaaa"},
    "customer_id": "cust-001",
    "status": "PENDING",
    "city": "Boston",
    "total": 99.99,
}
PLAIN = {"_id": "abc", "customer_id": "c1", "status": "PENDING", "city": "X", "total": 10.0}


def envelope(op, after=None, ts_ms=TS, stringified=True):
    body = json.dumps(after) if after is not None and stringified else after
    return json.dumps({"op": op, "ts_ms": ts_ms, "after": body, "source": {}, "transaction": None}).encode()


def key_of(oid):
    return json.dumps({"id": json.dumps({"$oid": oid})}).encode()


def record(value, key=None, topic=TOPIC, partition=0, offset=0, at_ms=TS, retries=None):
    at = datetime.fromtimestamp(at_ms / 1000, tz=timezone.utc)
    headers = None if retries is None else [{"key": "retry_count", "value": str(retries).encode()}]
    return (key, value, topic, partition, offset, at, headers)


def frame(spark, rows):
    return spark.createDataFrame(rows, CHANGE_RECORD)


def numbered(spark, rows):
    """Records with their list position as offset."""
    return frame(spark, [r[:4] + (i,) + r[5:] for i, r in enumerate(rows)])
