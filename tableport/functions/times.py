"""Zone-free timestamps read as UTC, whatever the session's time zone is."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def micros_since_epoch(naive: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", _epoch(), naive)


def utc_instant(naive: Column) -> Column:
    """timestamp_ntz -> the instant it names in UTC."""
    return F.timestamp_micros(micros_since_epoch(naive))


def utc_naive(instant: Column) -> Column:
    """Instant -> its UTC reading as timestamp_ntz."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _epoch())

