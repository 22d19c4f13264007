"""The merge must equal an event-by-event replay, for any split, order and repetition of batches."""

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelog.operators import merge
from tidelog.schemas import BIGINT, BOOLEAN, INT, STRING

FIELDS = ["status"]
SCHEMA = (
    StructType()
    .add("order_id", STRING)
    .add("topic", STRING)
    .add("partition", INT)
    .add("offset", BIGINT)
    .add("kafka_ts_ms", BIGINT)
    .add("event_ms", BIGINT)
    .add("is_delete", BOOLEAN)
    .add("status", STRING)
    .add("batch", INT)
)


def replayed(events):
    """Sequential application: insert or replace, keep the first time, delete."""
    rows = {}
    for e in sorted(events, key=lambda e: e[3]):
        key, event_ms, is_delete, status = e[0], e[5], e[6], e[7]
        if key == "":
            continue
        if is_delete:
            rows.pop(key, None)
        else:
            first = rows[key][0] if key in rows else event_ms
            rows[key] = (first, event_ms, status)
    return rows


def resolved(states):
    rows = merge.resolve(states, FIELDS).collect()
    assert len({r["order_id"] for r in rows}) == len(rows)
    return {r["order_id"]: (r["first_ms"], r["event_ms"], r["status"]) for r in rows}


def make_log(seed, keys, length):
    rng = random.Random(seed)
    events = []
    for offset in range(length):
        k = rng.randrange(keys) if rng.random() < 0.6 else 0  # key 0 is hot
        deleted = rng.random() < 0.3
        # Event times run backwards now and then: only arrival counts.
        ms = 1000 + rng.randrange(500)
        events.append((f"k{k}" if k else "hot", "t", k % 3, offset, 5000 + offset, ms, deleted, None if deleted else f"s{offset}"))
    return events


def batches_of(events, seed):
    """Contiguous batches per partition, overlapping and partly repeated, in any order."""
    rng = random.Random(seed)
    out = []
    number = 0
    for p in range(3):
        own = [e for e in events if e[2] == p]
        at = 0
        while at < len(own):
            size = rng.randint(1, max(1, len(own) // 3))
            start = max(0, at - rng.randint(0, 3))  # re-delivered tail of the batch before
            for repeat in range(rng.choice([1, 1, 2])):
                number += 1
                out += [e + (number,) for e in own[start : at + size]]
            at += size
    rng.shuffle(out)
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10**6), keys=st.integers(1, 40), length=st.integers(1, 300), span=st.sampled_from([1, 7, 65536]))
def test_any_batching_equals_sequential_replay(spark, seed, keys, length, span):
    events = make_log(seed, keys, length)
    want = replayed(events)
    frame = spark.createDataFrame(batches_of(events, seed), SCHEMA)
    states = merge.collapse(frame, FIELDS, span=span, apart=["batch"])
    assert resolved(states) == want
    assert resolved(merge.fold(states, FIELDS)) == want


def dealt(events, seed, parts=3):
    """Any records in any batch, most in one and some in several: nothing is contiguous."""
    rng = random.Random(seed)
    out = [e + (rng.randrange(parts),) for e in events for _ in range(rng.choice([1, 1, 1, 2]))]
    rng.shuffle(out)
    return out


def in_time(events):
    """Sequential application in the order of the source's times, ties by position."""
    again = sorted(events, key=lambda e: (e[5], e[2], e[3]))
    return replayed([e[:3] + (i,) + e[4:] for i, e in enumerate(again)])


def folded_in_steps(spark, rows, order, complete=None):
    """Each batch collapsed alone and folded into what the ones before have left."""
    kept = None
    for n in sorted({r[-1] for r in rows}):
        events = spark.createDataFrame([r for r in rows if r[-1] == n], SCHEMA)
        states = merge.collapse(events, FIELDS, span=64, gaps=True, order=order)
        kept = states if kept is None else merge.fold(kept.unionByName(states), FIELDS, order=order)
        kept = spark.createDataFrame(kept.collect(), kept.schema)
    return kept


def states_resolved(states, order):
    rows = merge.resolve(states, FIELDS, order=order).collect()
    assert len({r["order_id"] for r in rows}) == len(rows)
    return {r["order_id"]: (r["first_ms"], r["event_ms"], r["status"]) for r in rows}


@settings(max_examples=2, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10**6), keys=st.integers(1, 40), length=st.integers(1, 300))
def test_any_subsets_equal_sequential_replay(spark, seed, keys, length):
    events = make_log(seed, keys, length)
    rows = dealt(events, seed)
    frame = spark.createDataFrame(rows, SCHEMA)
    for order, want in ((merge.ARRIVAL, replayed(events)), (merge.SOURCE_TIME, in_time(events))):
        states = merge.collapse(frame, FIELDS, span=64, apart=["batch"], gaps=True, order=order)
        assert states_resolved(states, order) == want
        assert states_resolved(merge.fold(states, FIELDS, order=order), order) == want
        assert states_resolved(folded_in_steps(spark, rows, order), order) == want


def test_only_broken_partitions_keep_candidates(spark):
    """Partition 0 is unbroken and leaves one state a key, partition 1 lacks a record that comes later."""
    key = lambda p, o, ms, gone=False: (f"k{p}", "t", p, o, 10 + o, ms, gone, None if gone else f"s{o}", 1)
    rows = [key(p, o, 100 + o) for p in (0, 1) for o in (0, 1, 3, 4)] + [key(0, 2, 102)]
    states = merge.collapse(spark.createDataFrame(rows, SCHEMA), FIELDS, gaps=F.col("partition") == 1)
    assert {r["partition"]: r["n"] for r in states.groupBy("partition").agg(F.count("*").alias("n")).collect()} == {0: 1, 1: 4}
    late = merge.collapse(spark.createDataFrame([key(1, 2, 102, True)], SCHEMA), FIELDS, gaps=True)
    assert resolved(merge.fold(states.unionByName(late), FIELDS)) == {"k0": (100, 104, "s4"), "k1": (103, 104, "s4")}


def test_known_offsets_need_one_first_write(spark):
    rows = [("k", "t", 0, o, 10, 100 + o, False, f"s{o}", 1) for o in range(50)]
    states = merge.collapse(spark.createDataFrame(rows, SCHEMA), FIELDS, gaps=True)
    assert states.count() == 50
    known = lambda upto: spark.createDataFrame([("t", 0, upto)], "topic string, partition int, upto bigint")
    assert merge.fold(states, FIELDS, complete=known(39)).count() == 1 + 10
    whole = merge.fold(states, FIELDS, complete=known(49))
    assert whole.count() == 1 and resolved(whole) == {"k": (100, 149, "s49")}


def test_late_events_lose_by_source_time_only(spark):
    """A replayed older update arrives last, and a late delete falls between two writes."""
    rows = [
        ("k", "t", 0, 1, 10, 100, False, "first", 1),
        ("k", "t", 0, 2, 11, 300, False, "newest", 1),
        ("k", "t", 1, 9, 99, 200, False, "late", 1),
        ("j", "t", 0, 3, 10, 100, False, "a", 1),
        ("j", "t", 0, 4, 11, 300, False, "b", 1),
        ("j", "t", 0, 5, 12, 200, True, None, 1),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert states_resolved(merge.collapse(frame, FIELDS), merge.ARRIVAL) == {"k": (100, 200, "late")}
    by_time = merge.collapse(frame, FIELDS, order=merge.SOURCE_TIME)
    assert states_resolved(by_time, merge.SOURCE_TIME) == {"k": (100, 300, "newest"), "j": (300, 300, "b")}


@pytest.mark.parametrize(
    "ops, want",
    [
        ("cudcu", (4, 5)),
        ("cd", None),
        ("cu", (1, 2)),
        ("d", None),
        ("dc", (2, 2)),
        ("cdcdc", (5, 5)),
    ],
)
def test_first_seen_restarts_after_delete(spark, ops, want):
    rows = [
        ("k", "t", 0, i, 100 + i, i + 1, op == "d", None if op == "d" else op, 1) for i, op in enumerate(ops)
    ]
    got = resolved(merge.collapse(spark.createDataFrame(rows, SCHEMA), FIELDS))
    assert got == ({} if want is None else {"k": (*want, ops[-1])})


def test_key_moved_to_another_partition(spark):
    """Partitions of a key rank by their newest broker time; within one the offset decides."""
    rows = [
        ("k", "t", 0, 500, 1000, 1, False, "old", 1),
        ("k", "t", 1, 3, 2000, 2, True, None, 1),
        ("k", "t", 1, 4, 1990, 3, False, "new", 1),
    ]
    assert resolved(merge.collapse(spark.createDataFrame(rows, SCHEMA), FIELDS)) == {"k": (3, 3, "new")}


def test_empty_key_is_ignored_and_blank_key_is_not(spark):
    rows = [("", "t", 0, 1, 1, 1, False, "x", 1), ("   ", "t", 0, 2, 1, 1, False, "y", 1)]
    assert set(resolved(merge.collapse(spark.createDataFrame(rows, SCHEMA), FIELDS))) == {"   "}


def test_null_overwrites(spark):
    rows = [("k", "t", 0, 1, 1, 1, False, "x", 1), ("k", "t", 0, 2, 1, 2, False, None, 1)]
    assert resolved(merge.collapse(spark.createDataFrame(rows, SCHEMA), FIELDS)) == {"k": (1, 2, None)}


def test_groups_of_a_hot_key_are_bounded(spark):
    """One key with every record: no group exceeds the span before the states meet."""
    n, span = 5000, 100
    rows = spark.range(n).select(
        F.lit("hot").alias("order_id"), F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        F.col("id").alias("offset"), F.col("id").alias("kafka_ts_ms"), F.col("id").alias("event_ms"),
        (F.col("id") == 1234).alias("is_delete"), F.col("id").cast("string").alias("status"),
    )
    states = merge.collapse(rows, FIELDS, span=span)
    assert states.count() == n // span
    assert resolved(states) == {"hot": (1235, n - 1, str(n - 1))}
