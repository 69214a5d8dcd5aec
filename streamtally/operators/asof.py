"""As-of join with a bounded lookback."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamtally.operators.ordered import SLICE, last_known, micros, slice_hot_keys
from streamtally.settings import Settings


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    left_ts: str,
    right_key: str,
    right_ts: str,
    right_tie: str,
    payload: Sequence[str],
    lookback_seconds: int,
    settings: Settings,
    into: str = "match",
    name: str | None = None,
) -> DataFrame:
    """Adds struct `into` (right_ts and `payload`) of the latest right row of the same key
    in [left_ts - lookback, left_ts], both ends included; null where there is none.

    Both sides go into one timeline per key, shuffled once; filling the right rows forward
    over it finds every match, so nothing is paired up. A hot key's timeline is cut into
    slices. Left rows with a null key or time match nothing; those without a key are
    spread by their time, as they form no sequence.
    """
    keep = F.struct(*[F.col(c) for c in left.columns]).alias("_left")
    seen = F.struct(F.col(right_ts), *payload)
    seen_type = right.select(seen.alias("s")).schema["s"].dataType
    probes = left.select(
        F.col(left_key).alias("_key"),
        F.col(left_ts).alias("_ts"),
        F.lit(1).alias("_side"),
        F.lit(None).cast("long").alias("_tie"),
        F.lit(None).cast(seen_type).alias("_seen"),
        keep,
    )
    facts = right.where(F.col(right_key).isNotNull() & F.col(right_ts).isNotNull()).select(
        F.col(right_key).alias("_key"),
        F.col(right_ts).alias("_ts"),
        F.lit(0).alias("_side"),  # at equal times the fact comes first, so it matches
        F.col(right_tie).cast("long").alias("_tie"),
        seen.alias("_seen"),
    )
    timeline = slice_hot_keys(
        probes.unionByName(facts, allowMissingColumns=True), ["_key"], micros("_ts"), settings, name=name, ties=["_side", "_tie"]
    )
    lanes = max(8, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = -2 - F.pmod(F.xxhash64("_ts"), F.lit(lanes)).cast("int")
    timeline = timeline.withColumn(SLICE, F.when(F.col("_key").isNull(), spread).otherwise(F.col(SLICE)))
    filled = last_known(timeline, ["_key"], ["_ts", "_side", "_tie"], ["_seen"]).where(F.col("_side") == 1)
    age = F.unix_micros("_ts") - F.unix_micros(F.col(f"_seen.{right_ts}"))
    return filled.select("_left.*", F.when(age <= lookback_seconds * 1_000_000, F.col("_seen")).alias(into))
