from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_of(ts: str | Column) -> Column:
    return F.date_trunc("hour", ts)


def day_of(ts: str | Column) -> Column:
    return F.date_trunc("day", ts)


def quarter_hour_of(ts: str | Column) -> Column:
    """Start of the 15-minute bucket. Epoch-aligned, which gives the same borders as
    an origin of 2000-01-01 UTC."""
    width = 15 * 60 * 1_000_000
    at = F.unix_micros(ts)
    return F.timestamp_micros(at - F.pmod(at, F.lit(width)))


def seconds_between(earlier: str | Column, later: str | Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def plus_seconds(ts: str | Column, seconds: int) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + F.lit(seconds * 1_000_000))
