"""Keyed merge of a change log as mergeable states.

The result for a key depends on three things only: its last event, its last
delete, and its first write after that delete. A *state* row holds these for
some of a key's records in one topic partition. States combine: in any split,
in any order, with any overlap, the outcome is that of replaying the log event
by event. Re-delivered records therefore change nothing, and a batch never has
to look at the stored table before it is collapsed.

A state may stand for several records only if no other record of its partition
can fall between them, as a delete there would make a later write the first
one. So records of an unbroken stretch of offsets become one state, and where
offsets are missing (``gaps``) every write since the key's last known delete
stays a candidate, as a narrow row of its own. Candidates go once a later
delete is known, or once their partition is known up to them (``complete``).

A key may own any share of the log. Its events are first reduced per stretch
of ``SPAN`` offsets, so no task ever holds more than one stretch of a key;
only the reduced states meet at the key.

Two orders are offered. ``ARRIVAL`` is the default: within a topic partition the
offset alone decides, and partitions of a key are ranked by the latest broker
timestamp seen for it. ``SOURCE_TIME`` orders by the time of the change at its
source, ties by position: a late or replayed event loses against newer state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidelog.operators.project import target_columns
from tidelog.schemas import STATE
from tidelog.spec import Target, fields_read

# Offsets per stretch: the largest group one task sees for a key.
SPAN = 65536

POSITION = ("topic", "partition")

ARRIVAL, SOURCE_TIME = "arrival", "source_ts"


def _state_columns(last: Column, deleted: Column, first: Column, payload: Sequence[str]) -> list[Column]:
    return [
        F.col("last_offset"),
        F.col("last_kafka_ms"),
        deleted["offset"].alias("deleted_offset"),
        deleted["ms"].alias("deleted_ms"),
        first["offset"].alias("first_offset"),
        first["ms"].alias("first_ms"),
        *(last[name].alias(name) for name in ("is_delete", "event_ms", *payload)),
    ]


_PLACE = "struct<offset: bigint, ms: bigint>"


def _placed(offset: str, ms: str) -> Column:
    return F.when(F.col(offset).isNotNull(), F.struct(F.col(offset).alias("offset"), F.col(ms).alias("ms")))


def collapse(
    events: DataFrame,
    payload: Sequence[str],
    key: str = "order_id",
    span: int = SPAN,
    apart: Sequence[str] = (),
    gaps: bool | Column = False,
    order: str = ARRIVAL,
) -> DataFrame:
    """Reduce events to states per key, topic partition and stretch of offsets.

    ``events`` needs ``key, topic, partition, offset, kafka_ts_ms, event_ms,
    is_delete`` and the payload columns. Events with an empty key are no-ops.
    ``apart`` names further columns to group by, such as a batch number.
    ``gaps`` says, for all events or as a test of each, that records of their
    partition may lie between them which are not in ``events``.
    """
    events = events.filter(F.col(key) != "")
    if order == SOURCE_TIME or gaps is True:
        return _apart(events, payload, key, span, apart, order)
    if gaps is False:
        return _reduced(events, payload, key, span, apart)
    return _reduced(events.filter(~gaps), payload, key, span, apart).unionByName(
        _apart(events.filter(gaps), payload, key, span, apart, order)
    )


def _reduced(events: DataFrame, payload: Sequence[str], key: str, span: int, apart: Sequence[str]) -> DataFrame:
    """One state per key and unbroken stretch."""
    group = [key, *POSITION, "_span", *apart]
    own = Window.partitionBy(*group)
    spans = events.withColumn("_span", F.floor(F.col("offset") / span))
    spans = spans.withColumn("_deleted", F.max(F.when(F.col("is_delete"), F.col("offset"))).over(own))
    after_delete = ~F.col("is_delete") & (F.col("_deleted").isNull() | (F.col("offset") > F.col("_deleted")))
    place = F.struct(F.col("offset"), F.col("event_ms").alias("ms"))
    reduced = spans.groupBy(*group).agg(
        F.max_by(F.struct("is_delete", "event_ms", *payload), F.col("offset")).alias("_last"),
        F.max("offset").alias("last_offset"),
        F.max("kafka_ts_ms").alias("last_kafka_ms"),
        F.max(F.when(F.col("is_delete"), place)).alias("_gone"),
        F.min(F.when(after_delete, place)).alias("_first"),
    )
    return reduced.select(key, *POSITION, *_state_columns(F.col("_last"), F.col("_gone"), F.col("_first"), payload))


def _apart(events: DataFrame, payload: Sequence[str], key: str, span: int, apart: Sequence[str], order: str) -> DataFrame:
    """A state per event, without those that no missing record can bring back."""
    place = F.struct(F.col("offset"), F.col("event_ms").alias("ms"))
    states = events.select(
        key,
        *POSITION,
        *apart,
        F.floor(F.col("offset") / span).alias("_span"),
        F.col("offset").alias("last_offset"),
        F.col("kafka_ts_ms").alias("last_kafka_ms"),
        *(F.when(test, place)[name].alias(f"{prefix}_{name}") for prefix, test in (("deleted", F.col("is_delete")), ("first", ~F.col("is_delete"))) for name in ("offset", "ms")),
        "is_delete",
        "event_ms",
        *payload,
    )
    return _pruned(states, payload, [key, *POSITION, "_span", *apart], order).select(key, *STATE.names, *payload)


def fold(
    states: DataFrame,
    payload: Sequence[str],
    key: str = "order_id",
    complete: DataFrame | None = None,
    order: str = ARRIVAL,
) -> DataFrame:
    """Combine the states of a key; what other records can still change stays apart.

    ``complete`` (``topic, partition, upto``, a row per topic partition) names
    the offsets below which no record is missing: up to there one first write
    is enough. It does not help an order by source time, where late events may
    fall anywhere.
    """
    if order == SOURCE_TIME:
        return _pruned(states, payload, [key], order)
    if complete is None:
        known = states.withColumn("_upto", F.lit(None).cast("bigint"))
    else:
        # As many rows as topic partitions.
        known = states.join(F.broadcast(complete.select(*POSITION, F.col("upto").alias("_upto"))), list(POSITION), "left")
    return _pruned(known, payload, [key, *POSITION], order, upto=F.col("_upto"))


def _pruned(states: DataFrame, payload: Sequence[str], group: Sequence[str], order: str, upto: Column | None = None) -> DataFrame:
    own = Window.partitionBy(*group)
    rest = [c for c in group if c not in STATE.names]

    if order == SOURCE_TIME:

        def at(name: str, ms: str) -> Column:
            return F.when(F.col(f"{name}_offset").isNotNull(), F.struct(F.col(ms), *POSITION, F.col(f"{name}_offset").alias("offset")))

        marked = states.withColumns(
            {"_at": at("last", "event_ms"), "_gone_at": at("deleted", "deleted_ms"), "_first_at": at("first", "first_ms")}
        ).withColumns({"_newest": F.max("_at").over(own), "_gone": F.max("_gone_at").over(own)})
        newest, gone = F.col("_at") == F.col("_newest"), F.coalesce(F.col("_gone_at") == F.col("_gone"), F.lit(False))
        alive = F.coalesce(F.col("_first_at").isNotNull() & (F.col("_gone").isNull() | (F.col("_first_at") > F.col("_gone"))), F.lit(False))
        kept = marked.filter(newest | gone | alive)
        kept = kept.select(
            *rest,
            *(F.when(alive if n.startswith("first_") else gone, F.col(n)).alias(n) if n.startswith(("first_", "deleted_")) else F.col(n) for n in STATE.names),
            *(F.when(newest, F.col(n)).alias(n) for n in payload),
        )
        return kept.dropDuplicates([*rest, *STATE.names])

    marked = states.withColumns(
        {
            "_newest": F.max("last_offset").over(own),
            "_gone": F.max(_placed("deleted_offset", "deleted_ms")).over(own),
            "last_kafka_ms": F.max("last_kafka_ms").over(own),
        }
    )
    alive = F.col("first_offset").isNotNull() & (F.col("_gone").isNull() | (F.col("first_offset") > F.col("_gone.offset")))
    marked = marked.withColumn("_first", F.min(F.when(alive, _placed("first_offset", "first_ms"))).over(own))
    newest = F.col("last_offset") == F.col("_newest")
    # Nothing can come between the first write and another one in the known part.
    between = F.lit(True) if upto is None else F.coalesce(F.col("first_offset") > upto, F.lit(True))
    other = alive & (F.col("first_offset") > F.col("_first.offset")) & between
    # The newest row carries what is settled; a candidate is a first write and nothing else. A row may be both, and both
    # come from one pass: a union of two filters would compute everything before it twice, at every fold again.
    settled = F.when(
        newest, F.struct(F.lit(True).alias("settled"), F.col("last_offset").alias("last"), F.col("_gone").alias("gone"), F.col("_first").alias("first"))
    )
    candidate = F.when(
        other, F.struct(F.lit(False).alias("settled"), F.lit(None).cast("bigint").alias("last"), F.lit(None).cast(_PLACE).alias("gone"), _placed("first_offset", "first_ms").alias("first"))
    )
    kept = marked.filter(newest | other).withColumn("_as", F.explode(F.array_compact(F.array(settled, candidate))))
    # Of a re-delivered one, any copy.
    kept = kept.withColumn("_candidate", F.when(~F.col("_as.settled"), F.col("_as.first.offset"))).dropDuplicates([*group, "_candidate"])
    settled, place = F.col("_as.settled"), ("offset", "ms")
    return kept.select(
        *rest,
        *POSITION,
        F.col("_as.last").alias("last_offset"),
        "last_kafka_ms",
        *(F.col(f"_as.gone.{n}").alias(f"deleted_{n}") for n in place),
        *(F.col(f"_as.first.{n}").alias(f"first_{n}") for n in place),
        *(F.when(settled, F.col(n)).alias(n) for n in ("is_delete", "event_ms", *payload)),
    )


def resolve(
    states: DataFrame, payload: Sequence[str], key: str = "order_id", keep_deleted: bool = False, order: str = ARRIVAL
) -> DataFrame:
    """Current row per key: payload, ``first_ms`` (first write since the last delete) and ``event_ms``.

    One shuffle on the key serves both windows and the aggregate. Keys whose
    last event is a delete are absent unless ``keep_deleted``.
    """
    in_partition = Window.partitionBy(key, *POSITION)
    in_key = Window.partitionBy(key)

    def at(offset: str, ms: str) -> Column:
        before = F.col(ms) if order == SOURCE_TIME else F.col("_rank")
        return F.struct(before.alias("rank"), F.col("topic"), F.col("partition"), F.col(offset).alias("offset"))

    ranked = states.repartition(F.col(key))
    if order == ARRIVAL:
        ranked = ranked.withColumn("_rank", F.max("last_kafka_ms").over(in_partition))
    ranked = ranked.withColumn(
        "_deleted", F.max(F.when(F.col("deleted_offset").isNotNull(), at("deleted_offset", "deleted_ms"))).over(in_key)
    )
    first_at = at("first_offset", "first_ms")
    alive_since = F.when(
        F.col("first_offset").isNotNull() & (F.col("_deleted").isNull() | (first_at > F.col("_deleted"))),
        F.struct(first_at.alias("at"), F.col("first_ms").alias("ms")),
    )
    rows = ranked.groupBy(key).agg(
        F.max_by(
            F.struct("is_delete", "event_ms", *payload, *POSITION, F.col("last_offset").alias("offset")),
            at("last_offset", "event_ms"),
        ).alias("_last"),
        F.min(alive_since).alias("_first"),
    )
    rows = rows.select(
        key,
        F.coalesce(F.col("_first.ms"), F.col("_last.event_ms")).alias("first_ms"),
        "_last.event_ms",
        *(f"_last.{name}" for name in payload),
        "_last.topic",
        "_last.partition",
        "_last.offset",
        "_last.is_delete",
    )
    return rows if keep_deleted else rows.filter(~F.col("is_delete")).drop("is_delete")


def target_payload(target: Target) -> list[str]:
    return [name for name, _ in target.columns]


def target_states(states: DataFrame, target: Target) -> DataFrame:
    """States over document fields as states over the columns of one target."""
    return states.select(target.key, *STATE.names, *target_columns(target))


def _times(target: Target) -> list[Column]:
    times = [F.timestamp_millis("event_ms").alias(target.changed_at)]
    if target.inserted_at:
        times.insert(0, F.timestamp_millis("first_ms").alias(target.inserted_at))
    return times


def stored_rows(resolved: DataFrame, target: Target) -> DataFrame:
    """Resolved states over target columns in the layout of the table."""
    return resolved.select(target.key, *target_payload(target), *_times(target))


def target_rows(resolved: DataFrame, target: Target) -> DataFrame:
    """Resolved states over document fields in the layout of the table."""
    return resolved.select(target.key, *target_columns(target), *_times(target))


def replay(applied: DataFrame, *targets: Target, span: int = SPAN, order: str = ARRIVAL) -> list[DataFrame]:
    """The target tables after applying a whole log (``project.document_fields``).

    They share one collapse and one resolve over the fields any of them reads;
    a plan that uses several of them shuffles the log once.
    """
    payload = fields_read(*targets)
    resolved = resolve(collapse(applied, payload, span=span, order=order), payload, order=order)
    return [target_rows(resolved, target) for target in targets]
