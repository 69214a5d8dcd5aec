"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamtally.operators.ordered import order_key


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """The `columns` of each key's last row. Aggregates map-side, so a hot key is
    reduced to one row per task before anything is shuffled."""
    picked = F.max_by(F.struct(*columns), order_key(order)).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*keys, "_row.*")
