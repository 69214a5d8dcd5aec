"""`rank() ... order by value desc` without sorting a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamtally.operators.ordered import running_sum, slice_hot_keys
from streamtally.settings import Settings


def rank_descending(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    into: str,
    settings: Settings,
    levels: DataFrame | None = None,
    name: str | None = None,
) -> DataFrame:
    """Adds the rank of `value` within `keys` (none: over all rows), greatest and null first.

    Rows are first reduced to one per distinct value with its row count; the rank
    of a value is one plus the rows on greater values. Rows that share a value
    therefore never meet in one window partition, however many they are. A null key is a
    key of its own. Where `df` is costly to compute, pass the reduced table (keys, value,
    `_rows`) in `levels`.
    """
    if levels is None:
        levels = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_rows"))
    sliced = slice_hot_keys(levels, keys, -F.col(value).cast("double"), settings, nulls_first=True, name=name)
    ranked = running_sum(sliced, keys, [F.col(value).desc_nulls_first()], "_rows", "_upto").select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col(value).alias("_level"),
        (F.col("_upto") - F.col("_rows") + 1).cast("long").alias(into),
    )
    match = F.col(value).eqNullSafe(F.col("_level"))
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return df.join(ranked, match).drop("_level", *[f"_k_{k}" for k in keys])
