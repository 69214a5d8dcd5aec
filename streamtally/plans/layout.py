"""Staged tables laid out by time and channel, for queries that come back to them.

A laid-out table is partitioned by day and bucketed by channel and hour. A span of days is a filter on folders,
and whatever joins or groups by channel and hour reads each bucket where it is: nothing is shuffled. The hour is part of
the bucket, so a busy channel is spread over as many buckets as it has hours.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamtally.functions.ratio import rows
from streamtally.operators.intervals import cell_of, cells_of_spans, inside_spans
from streamtally.settings import Settings

DAY, CELL = "event_day", "_cell"


def lay_out(df: DataFrame, key: str, ts: str, path: str, buckets: int, settings: Settings) -> DataFrame:
    """Writes the rows that have a `ts` and reads them back with their day, and their hour as `_cell`. Give tables
    that are to meet the same number of buckets, one for about 128 MB of the largest."""
    placed = df.where(F.col(ts).isNotNull()).withColumns({CELL: cell_of(ts, settings), DAY: F.to_date(ts)})
    return _written(placed, key, path, buckets)


def lay_out_spans(spans: DataFrame, key: str, start: str, end: str, path: str, buckets: int, settings: Settings) -> DataFrame:
    """The spans, once for every hour they touch, to meet the points of a table from `lay_out`."""
    placed = cells_of_spans(spans, start, end, settings).withColumn(DAY, F.to_date(start))
    return _written(placed, key, path, buckets)


def _written(placed: DataFrame, key: str, path: str, buckets: int) -> DataFrame:
    name = f"laid_out_{uuid.uuid4().hex}"
    # One task per bucket writes one file a day.
    dealt = placed.repartition(buckets, key, CELL)
    writer = dealt.write.option("path", path).option("compression", "zstd").partitionBy(DAY)
    writer.bucketBy(buckets, key, CELL).sortBy(key, CELL).saveAsTable(name)
    return placed.sparkSession.table(name)


def hourly_messages(chat: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Messages per channel and hour of a laid-out chat table, of these days only."""
    days = F.col(DAY).between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    return (
        chat.where(days)
        .groupBy("channel", CELL)
        .agg(F.date_trunc("hour", F.min("message_sent_at")).alias("hour_bucket"), rows().alias("message_count"))
        .drop(CELL)
    )


def session_talk(chat: DataFrame, spans: DataFrame) -> DataFrame:
    """Messages in the first and second half of each broadcast, of laid-out chat and broadcasts."""
    length = F.unix_micros("last_seen_at") - F.unix_micros("first_seen_at")
    early = 2 * (F.unix_micros("message_sent_at") - F.unix_micros("first_seen_at")) < length
    met = inside_spans(chat.drop(DAY), spans.drop(DAY), "channel", "message_sent_at", "first_seen_at", "last_seen_at")
    return met.groupBy("channel", "stream_started_at").agg(
        F.count_if(early).alias("message_count_first_half"), F.count_if(~early).alias("message_count_second_half")
    )
