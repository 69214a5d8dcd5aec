from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Double quotient, null where the denominator is zero or null."""
    n = F.col(numerator) if isinstance(numerator, str) else numerator
    d = F.col(denominator) if isinstance(denominator, str) else denominator
    d = d.cast("double")
    return n.cast("double") / F.nullif(d, F.lit(0.0))


def when_positive(guard: str | Column, value: Column) -> Column:
    g = F.col(guard) if isinstance(guard, str) else guard
    return F.when(g > 0, value)


def rows() -> Column:
    """count(*)"""
    return F.count(F.lit(1))
