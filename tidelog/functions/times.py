"""Epoch-millisecond times and stage latencies."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


#: Largest distance from 1970 in ms that a timestamp (64-bit microseconds) holds.
MAX_MS = 9_223_372_036_854_775


def is_timestamp_ms(ms: Column) -> Column:
    """Whether the milliseconds can become a timestamp; null stays null."""
    return ms.between(-MAX_MS, MAX_MS)


def ms_to_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def timestamp_to_ms(ts: Column) -> Column:
    return F.unix_millis(ts)


def or_ingest_time(ts_ms: Column, ingest_ms: Column) -> Column:
    """Event time in ms; an absent or zero time falls back to the time of ingestion."""
    return F.when(ts_ms != 0, ts_ms).otherwise(ingest_ms)


def latency(start_ms: Column, end_ms: Column) -> Column:
    """Milliseconds between two clocks, never negative, in 64 bits."""
    return F.greatest(F.lit(0).cast("bigint"), end_ms - start_ms)


def clock_text(ms: Column) -> Column:
    """``HH:MM:SS.mmm`` in UTC."""
    return F.date_format(ms_to_timestamp(ms), "HH:mm:ss.SSS")


def iso_text(ts: Column) -> Column:
    """ISO-8601 with UTC offset; the fraction is left out when it is zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.concat(whole, F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)), F.lit("+00:00"))
