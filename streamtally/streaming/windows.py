"""Windowed and de-duplicated views of the chat stream.

Functions take and return streaming DataFrames; they work on batch ones too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamtally.functions.ratio import rows
from streamtally.schemas import EVENT_LOG_KEY

LATE_BY = "15 minutes"


def dedup(
    stream: DataFrame, clock: str = "captured_at", key: Sequence[str] = EVENT_LOG_KEY, late_by: str = LATE_BY
) -> DataFrame:
    """Drops replays that arrive within the watermark; older ones are caught by the
    anti-join of the ingest sink."""
    return stream.withWatermark(clock, late_by).dropDuplicatesWithinWatermark(list(key))


HOUR_KEYS = ["hour_bucket", "channel", "chatter_id"]
QUARTER_KEYS = ["quarter_hour_bucket", "chatter_id", "channel"]


def _parts(chat: DataFrame, width: str, bucket: str, keys: Sequence[str], late_by: str) -> DataFrame:
    counted = chat.withWatermark("message_sent_at", late_by).groupBy(F.window("message_sent_at", width).alias("_w"), *keys)
    return counted.agg(rows().alias("part_count")).select(F.col("_w.start").alias(bucket), *keys, "part_count")


def hourly_chat_parts(chat: DataFrame, late_by: str = LATE_BY) -> DataFrame:
    """Messages per (hour, channel, chatter); for update mode with an upsert on HOUR_KEYS, so hours that
    are still open show what they have so far. Exact distinct counts are not available on streams; one
    row per chatter gives them, and splits a busy channel. Rows later than `late_by` are dropped and
    counted in the query's progress (numRowsDroppedByWatermark)."""
    return _parts(chat, "1 hour", "hour_bucket", ["channel", "chatter_id"], late_by)


def hourly_chat(parts: DataFrame) -> DataFrame:
    """Messages and distinct chatters per (channel, hour) of the table that holds the parts."""
    return parts.groupBy("channel", "hour_bucket").agg(
        F.sum("part_count").alias("message_count"), F.count("chatter_id").alias("unique_chatter_count")
    )


def quarter_hour_parts(chat: DataFrame, late_by: str = LATE_BY) -> DataFrame:
    """Messages per (quarter hour, chatter, channel), like `hourly_chat_parts`."""
    known = chat.where(F.col("chatter_id").isNotNull())
    return _parts(known, "15 minutes", "quarter_hour_bucket", ["chatter_id", "channel"], late_by)


def quarter_hours(parts: DataFrame) -> DataFrame:
    """Messages and distinct channels per (chatter, quarter hour)."""
    return parts.groupBy("chatter_id", "quarter_hour_bucket").agg(
        rows().alias("distinct_channel_count"), F.sum("part_count").alias("message_count")
    )


def running_counts(chat: DataFrame) -> DataFrame:
    """Messages so far per (channel, chatter); for update mode with an upsert."""
    return chat.groupBy("channel", "chatter").agg(rows().alias("message_count"))


def channel_running_counts(chat: DataFrame) -> DataFrame:
    """Messages so far per channel; for update mode with an upsert."""
    return chat.groupBy("channel").agg(rows().alias("message_count"))


def last_seen(stream: DataFrame, clock: str = "captured_at") -> DataFrame:
    """Newest row per channel; for update mode with an upsert."""
    return stream.groupBy("channel").agg(F.max(clock).alias("last_seen_at"))


def stalled(seen: DataFrame, now: Column, minutes: int) -> DataFrame:
    """Channels of `last_seen` without rows for more than `minutes` before `now`."""
    silent = (F.unix_micros(now) - F.unix_micros("last_seen_at")) / F.lit(60e6)
    return seen.withColumn("silent_minutes", silent).where(F.col("silent_minutes") > minutes)
