"""Offset positions, consumer lag and queue reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from tidelog.functions.rows import one_row
from tidelog.functions.times import iso_text
from tidelog.schemas import OFFSET_AUDIT, OFFSETS, conform

# Fixed values.
TOPIC_PREFIX = "poc."
FEW_PENDING = 50
LAG_ALERT = 5000
STALE_AFTER = "INTERVAL 5 MINUTES"
CONSUMER_GROUP = "poc-pipeline-consumer"

_POSITIONS = "map<string, map<string, bigint>>"


def positions_of_log(records: DataFrame) -> DataFrame:
    """Low offset and next offset per partition of a change log."""
    return records.groupBy("topic", "partition").agg(
        F.min("offset").alias("low"), (F.max("offset") + 1).alias("high")
    )


def batch_summary(events: DataFrame, counts: Mapping[str, Column]) -> DataFrame:
    """One row per topic partition of a batch: ``low``, ``committed``, ``unbroken``, and ``counts`` (name -> test).

    ``unbroken`` tells whether the batch holds every offset from the first to
    the last. Offsets are marked in bitmaps, so that repeated records count
    once and nothing but the bitmaps is shuffled.
    """
    marks = F.bitmap_construct_agg(F.bitmap_bit_position("offset"))
    parts = events.groupBy("topic", "partition", F.bitmap_bucket_number("offset").alias("_bucket")).agg(
        F.min("offset").alias("low"),
        F.max("offset").alias("last"),
        F.bitmap_count(marks).alias("held"),
        *(F.count_if(test).alias(name) for name, test in counts.items()),
    )
    return parts.groupBy("topic", "partition").agg(
        F.min("low").alias("low"),
        (F.max("last") + 1).alias("committed"),
        (F.sum("held") == F.max("last") + 1 - F.min("low")).alias("unbroken"),
        *(F.sum(name).alias(name) for name in counts),
    )


def complete_positions(audit: DataFrame) -> DataFrame:
    """How far each topic partition is known without a gap: ``topic, partition, upto``, from audited batches.

    Unbroken batches are put in the order of their first offset; the first
    that begins behind the end of all before it ends the run. Batches that are
    broken themselves add nothing.
    """
    own = Window.partitionBy("topic", "partition").orderBy("low", "committed")
    reached = F.max("committed").over(own.rowsBetween(Window.unboundedPreceding, -1))
    runs = audit.filter("unbroken").withColumn("_gap", F.col("low") > F.coalesce(reached, F.col("low")))
    known = runs.withColumn("_behind", F.max("_gap").over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return known.filter(~F.col("_behind")).groupBy("topic", "partition").agg((F.max("committed") - 1).alias("upto"))


def lag_of_job(audit: DataFrame, log: DataFrame) -> DataFrame:
    """Offset positions of a job: what its latest audit says is committed, against what the log holds."""
    committed = audit.groupBy("topic", "partition").agg(F.max_by("committed", F.struct("ts", "committed")).alias("committed"))
    return conform(positions_of_log(log).join(committed, ["topic", "partition"], "left"), OFFSETS)


def positions_of_progress(progress: DataFrame) -> DataFrame:
    """Offset positions from a streaming query's progress, one row per report.

    ``progress`` has the JSON columns ``end_offset`` (what the query committed)
    and ``latest_offset`` (what the broker holds), both {topic: {partition: n}}.
    """

    def unfolded(column: str, name: str) -> DataFrame:
        topics = progress.select(F.explode(F.from_json(F.col(column), _POSITIONS)).alias("topic", "parts"))
        return topics.select("topic", F.explode("parts").alias("p", name)).select(
            "topic", F.col("p").cast("int").alias("partition"), name
        )

    high = unfolded("latest_offset", "high").groupBy("topic", "partition").agg(F.max("high").alias("high"))
    committed = unfolded("end_offset", "committed").groupBy("topic", "partition").agg(F.max("committed").alias("committed"))
    return conform(high.join(committed, ["topic", "partition"], "left"), OFFSETS)


def committed_or_zero() -> Column:
    return F.greatest(F.coalesce(F.col("committed"), F.lit(0)), F.lit(0))


def lag_by_partition(offsets: DataFrame) -> DataFrame:
    """Lag per partition, never negative; a partition without a commit starts at 0."""
    done = committed_or_zero()
    return offsets.select(
        "topic",
        "partition",
        done.alias("committed"),
        "high",
        F.greatest(F.lit(0), F.col("high") - done).alias("lag"),
    )


def sorted_lag(offsets: DataFrame) -> DataFrame:
    return lag_by_partition(offsets).orderBy("topic", "partition")


def lag_rollup(offsets: DataFrame) -> DataFrame:
    """Lag per partition, per topic and in total from one aggregate."""
    level = (
        F.when(F.grouping_id() == 0, "partition").when(F.grouping_id() == 1, "topic").otherwise("total")
    )
    return (
        lag_by_partition(offsets)
        .rollup("topic", "partition")
        .agg(F.sum("lag").alias("lag"), level.alias("level"))
    )


def lag_alert(offsets: DataFrame, limit: int = LAG_ALERT) -> DataFrame:
    """Topics whose lag exceeds the limit."""
    return lag_by_partition(offsets).groupBy("topic").agg(F.sum("lag").alias("lag")).filter(F.col("lag") > limit)


def topic_progress(offsets: DataFrame) -> DataFrame:
    """Share consumed and severity per topic."""
    sums = lag_by_partition(offsets).groupBy("topic").agg(
        F.sum("high").alias("produced"), F.sum("committed").alias("committed"), F.sum("lag").alias("lag")
    )
    share = F.when(F.col("produced") > 0, F.col("committed") / F.col("produced")).otherwise(F.lit(1.0))
    severity = F.when(F.col("lag") == 0, "caught_up").when(F.col("lag") < FEW_PENDING, "few").otherwise("many")
    return sums.select("*", F.least(F.lit(1.0), share).alias("consumed"), severity.alias("severity"))


def catch_up_seconds(lag: Column, per_minute: Column) -> Column:
    """Seconds until the lag is gone at the given rate, null unless both are positive."""
    return F.when((lag > 0) & (per_minute > 0), F.try_divide(lag * F.lit(60.0), per_minute))


def queue_status(offsets: DataFrame, metrics: DataFrame, as_of: Column) -> DataFrame:
    """Produced, committed, written, skipped and pending totals with the catch-up estimate, one row."""
    positions = lag_by_partition(offsets).agg(
        F.coalesce(F.sum("high"), F.lit(0)).alias("produced"),
        F.coalesce(F.sum("committed"), F.lit(0)).alias("committed"),
        F.coalesce(F.sum("lag"), F.lit(0)).alias("pending"),
    )
    recent = metrics.select((F.col("recorded_at") > as_of - F.expr("INTERVAL 1 MINUTE")).alias("recent"))
    written = recent.agg(F.count("*").alias("written"), F.count_if("recent").alias("tput_1m"))
    return one_row(positions, written).select(
        "produced",
        "committed",
        "written",
        F.greatest(F.lit(0), F.col("committed") - F.col("written")).alias("skipped"),
        "pending",
        "tput_1m",
        catch_up_seconds(F.col("pending"), F.col("tput_1m")).alias("eta_seconds"),
    )


def list_topics(records: DataFrame, prefix: str = TOPIC_PREFIX) -> DataFrame:
    """Topic names with the prefix, sorted."""
    return records.select("topic").filter(F.col("topic").startswith(prefix)).distinct().orderBy("topic")


def stale_topics(records: DataFrame, as_of: Column, after: str = STALE_AFTER) -> DataFrame:
    """Topics without a record in the last five minutes before ``as_of``."""
    last = records.groupBy("topic").agg(F.max("timestamp").alias("last_at"))
    return last.filter(F.col("last_at") < as_of - F.expr(after))


def starting_offsets(offsets: DataFrame, position: str | int) -> DataFrame:
    """The ``startingOffsets`` JSON of a new streaming query as one row.

    ``position`` is ``earliest``, ``latest``, ``committed`` or an offset for
    every partition. The input is one row per partition, so the collected
    lists are as short as the cluster's partition list.
    """
    if isinstance(position, int):
        start = F.lit(position).cast("bigint")
    else:
        start = {
            "earliest": F.col("low"),
            "latest": F.col("high"),
            "committed": committed_or_zero(),
        }[position]
    parts = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("partition").cast("string"), start))))
    per_topic = offsets.groupBy("topic").agg(F.to_json(parts).alias("parts"))
    topics = F.transform(
        F.array_sort(F.collect_list(F.struct("topic", "parts"))),
        lambda t: F.concat(F.lit('"'), t["topic"], F.lit('":'), t["parts"]),
    )
    return per_topic.agg(F.concat(F.lit("{"), F.array_join(topics, ","), F.lit("}")).alias("starting_offsets"))


def audit_rows(positions: DataFrame, at: Column, group: str = CONSUMER_GROUP, schema: StructType = OFFSET_AUDIT) -> DataFrame:
    """Audit rows for committed positions (``topic, partition, committed``, and what else the schema names)."""
    return conform(positions.select("*", iso_text(at).alias("ts"), F.lit(group).alias("group_id")), schema)
