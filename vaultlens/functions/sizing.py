"""Numeric expressions: chunk counts, partition size, pacing and routing states."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaultlens.constants import (CHUNK_SIZE, DAILY_QUOTA_BYTES, DEFAULT_PARTITION_SIZE,
                                 MIN_THROTTLING_DELAY, PARTITIONS_PER_DAY, SECONDS_PER_DAY)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def idiv(a, b) -> Column:
    """Integer division (SQL ``div``), exact for any bigint."""
    b = F.lit(b) if isinstance(b, int) else _c(b)
    return F.call_function("div", _c(a).cast("bigint"), b.cast("bigint"))


def part_day(part) -> Column:
    """Day of a request partition: its folder in the written table."""
    return idiv(part, PARTITIONS_PER_DAY)


def chunk_count(size, unit: int = CHUNK_SIZE) -> Column:
    """``ceil(size / unit)`` in integer arithmetic; 0 for size 0."""
    return idiv(_c(size) + F.lit(unit - 1), unit)


def partition_size(archive_count, vault_bytes, quota: int = DAILY_QUOTA_BYTES) -> Column:
    """Archives per request partition so that a day holds at least 16 partitions."""
    days = F.ceil(_c(vault_bytes) / F.lit(float(quota)))
    small = F.ceil(_c(archive_count) / F.lit(float(PARTITIONS_PER_DAY)) / days)
    return (F.when(days * F.lit(PARTITIONS_PER_DAY * DEFAULT_PARTITION_SIZE) < _c(archive_count),
                   F.lit(DEFAULT_PARTITION_SIZE))
             .otherwise(small)).cast("bigint")


def request_wait_seconds(bytes_col, throttled_col, elapsed_col=None, quota: int = DAILY_QUOTA_BYTES) -> Column:
    """Seconds to wait before the next partition is requested.

    ``max(0, round_half_up(86400 * (bytes + throttled) / quota) - elapsed)``;
    when that is 0 but bytes were throttled, the minimum throttling delay.
    """
    elapsed = F.lit(0) if elapsed_col is None else _c(elapsed_col)
    share = (_c(bytes_col) + _c(throttled_col)) / F.lit(float(quota))
    wait = F.floor(F.lit(float(SECONDS_PER_DAY)) * share + F.lit(0.5)).cast("bigint") - elapsed
    wait = F.greatest(wait, F.lit(0)).cast("bigint")
    return F.when((wait == 0) & (_c(throttled_col) > 0), F.lit(MIN_THROTTLING_DELAY).cast("bigint")).otherwise(wait)


def consistency_state(inventory_count, partitioned_count) -> Column:
    """FAIL when the inventory is empty or a partitioned table disagrees; READY when
    it agrees; PARTITION when none has been written yet."""
    inv = _c(inventory_count)
    part = _c(partitioned_count)
    return (F.when(F.coalesce(inv, F.lit(0)) == 0, F.lit("FAIL"))
             .when((F.coalesce(part, F.lit(0)) != 0) & (part != inv), F.lit("FAIL"))
             .when(part == inv, F.lit("READY"))
             .otherwise(F.lit("PARTITION")))


def int_parse(text) -> Column:
    """Text -> bigint; NULL when it is not a number (never fails the job)."""
    return _c(text).try_cast("bigint")


def iso_timestamp(ts) -> Column:
    """Timestamp -> ISO-8601 text with a numeric offset (``2020-08-23T10:18:22+00:00``)."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ssxxx")
