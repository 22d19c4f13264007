"""Latency and throughput reports over the metrics table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidelog.functions.rows import one_row, or_zero
from tidelog.operators.percentiles import exact_percentiles, percentiles_of_counts
from tidelog.operators.project import recent_view

# Reported percentiles and throughput windows.
PERCENTILES = {"p50_ms": 0.50, "p95_ms": 0.95, "p99_ms": 0.99}
WINDOWS = {"tput_5m": "INTERVAL 5 MINUTES", "tput_1m": "INTERVAL 1 MINUTE"}
LATENCY_POINTS = 100
RECENT_EVENTS = 20

_AVERAGES = {
    "avg_e2e_ms": "e2e_lat_ms",
    "avg_bytes": "doc_size_bytes",
    "avg_deb_ms": "debezium_lat_ms",
    "avg_con_ms": "consumer_lat_ms",
    "avg_wrt_ms": "write_lat_ms",
}
_NEWEST = ("recorded_at", "topic", "partition", "offset")


def _within() -> list[Column]:
    return [F.count_if(F.col("recorded_at") > F.col("_as_of") - F.expr(length)).alias(name) for name, length in WINDOWS.items()]


def throughput(metrics: DataFrame, as_of: Column) -> DataFrame:
    """Rows recorded within the last minutes before ``as_of``, one row.

    Only those minutes are read: the filter reaches the scan, and prunes the
    ``day`` partitions of a stored metrics dataset.
    """
    since = as_of - F.expr(max(WINDOWS.values(), key=lambda w: int(w.split()[1])))
    recent = metrics.filter(F.col("recorded_at") > since)
    if "day" in metrics.columns:
        recent = recent.filter(F.col("day") >= F.to_date(since))
    return recent.select("recorded_at", as_of.alias("_as_of")).agg(*_within())


def kpis(metrics: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Counts, averages, exact percentiles and throughput as one row; zeros for an empty table.

    Averages round halves away from zero, percentiles to even, as the SQL
    database behind the original reports does for its numeric and double types.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    totals = metrics.select("recorded_at", *dict.fromkeys(_AVERAGES.values()), as_of.alias("_as_of")).agg(
        F.count("*").alias("total_docs"),
        *(or_zero(F.round(F.avg(column))).alias(name) for name, column in _AVERAGES.items()),
        *_within(),
    )
    percentiles = exact_percentiles(metrics, "e2e_lat_ms", PERCENTILES).select(
        *(or_zero(F.rint(name)).alias(name) for name in PERCENTILES)
    )
    return one_row(totals, percentiles)


def daily_counts(metrics: DataFrame) -> DataFrame:
    """What ``kpis`` needs of the metric rows of each ``day``: per latency their number, sums and newest time.

    Counts of disjoint rows add up, so a day may have several rows for a latency.
    """
    summed = [column for column in _AVERAGES.values() if column != "e2e_lat_ms"]
    return metrics.groupBy("day", "e2e_lat_ms").agg(
        F.count("*").alias("n"),
        F.max("recorded_at").alias("newest"),
        *(F.sum(F.col(column).cast("bigint")).alias(column) for column in summed),
        *(F.count(column).alias(f"n_{column}") for column in summed),
    )


def kpis_of_counts(counts: DataFrame, metrics: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The report of ``kpis`` from ``daily_counts``. Of the metric rows themselves only the last minutes are read.

    ``as_of`` defaults to the newest time counted.
    """
    as_of = counts.agg(F.max("newest")).scalar() if as_of is None else as_of
    known = F.col("e2e_lat_ms").isNotNull()

    def mean(column: str) -> Column:
        if column == "e2e_lat_ms":
            total, n = F.sum(F.col(column) * F.col("n")), F.sum(F.when(known, F.col("n")))
        else:
            total, n = F.sum(column), F.sum(f"n_{column}")
        return or_zero(F.round(F.try_divide(total.cast("double"), n)))

    totals = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_docs"), *(mean(column).alias(name) for name, column in _AVERAGES.items())
    )
    values = counts.filter(known).groupBy(F.col("e2e_lat_ms").alias("v")).agg(F.sum("n").alias("n"))
    percentiles = percentiles_of_counts(values, PERCENTILES).select(*(or_zero(F.rint(name)).alias(name) for name in PERCENTILES))
    return one_row(totals, percentiles, throughput(metrics, as_of))


def latest(metrics: DataFrame, n: int) -> DataFrame:
    """The n newest rows; ties break by position, so the choice is stable."""
    return metrics.orderBy(*(F.desc(c) for c in _NEWEST)).limit(n)


def latency_series(metrics: DataFrame, n: int = LATENCY_POINTS) -> DataFrame:
    """Newest latency points, oldest first."""
    order = list(_NEWEST)
    points = latest(
        metrics.select(*order, "e2e_lat_ms", "debezium_lat_ms", "consumer_lat_ms", "write_lat_ms"), n
    )
    return points.orderBy(*order).drop("topic", "partition", "offset")


def recent_events(metrics: DataFrame, n: int = RECENT_EVENTS) -> DataFrame:
    """Newest events with readable times, newest first."""
    return recent_view(latest(metrics, n))


def per_minute(metrics: DataFrame, late: str = "5 minutes") -> DataFrame:
    """Events and mean latency per minute; bounded state when ``metrics`` is a stream.

    ``late`` is what that bound costs: in a stream, rows recorded longer than
    this before the newest row seen are dropped (a batch keeps all). Raise it
    where batches may be recorded out of order.
    """
    return (
        metrics.withWatermark("recorded_at", late)
        .groupBy(F.window("recorded_at", "1 minute"))
        .agg(F.count("*").alias("n"), F.avg("e2e_lat_ms").alias("avg_e2e_ms"))
        .select(F.col("window.start").alias("minute"), "n", "avg_e2e_ms")
    )
