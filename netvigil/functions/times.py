"""Event-time columns: epoch milliseconds, fixed buckets, UTC text."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F


def event_ms(column: str = "timestamp") -> Column:
    return F.unix_millis(F.col(column))


def to_ms(moment: datetime | int) -> int:
    """Epoch milliseconds of a datetime (naive ones are UTC) or of an integer already in them."""
    if isinstance(moment, int):
        return moment
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return int(moment.timestamp() * 1000)


def moment(ms: Column | int) -> Column:
    """Timestamp of an epoch-millisecond value; a plain integer becomes a literal scans can use."""
    return F.timestamp_millis(F.lit(ms) if isinstance(ms, int) else ms)


def bucket_start(ms: Column, width: Column | int) -> Column:
    """Start of the epoch-aligned bucket holding ``ms``."""
    width = F.lit(width).cast("bigint") if isinstance(width, int) else width
    return ms - F.pmod(ms, width)


def utc_text(ms: Column, pattern: str) -> Column:
    """UTC text of epoch milliseconds, whatever the session's time zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.date_format(F.timestamp_add("MILLISECOND", ms, epoch), pattern)


def iso_millis(ms: Column) -> Column:
    return utc_text(ms, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def iso_seconds(ms: Column) -> Column:
    return utc_text(ms, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def daily_name(prefix: str, ms: Column) -> Column:
    """Name of the daily partition of a moment, such as ``prefix2024.01.31``."""
    return F.concat(F.lit(prefix), utc_text(ms, "yyyy.MM.dd"))


def partition_date(source_index: Column) -> Column:
    """Date at the end of a daily partition name."""
    return F.translate(F.right(source_index, F.lit(10)), ".", "-").try_cast("date")
