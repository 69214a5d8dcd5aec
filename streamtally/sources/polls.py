"""Stream polls: who of the roster is live, and what changed since."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamtally.functions.ratio import rows
from streamtally.functions.time import seconds_between
from streamtally.operators.ordered import last_known, micros, previous_row, slice_hot_keys
from streamtally.operators.product import each_with_all
from streamtally.settings import Settings


def build_metadata_snapshots(
    polls: DataFrame, roster: DataFrame, live: DataFrame, settings: Settings
) -> DataFrame:
    """One row per (poll, roster channel).

    `polls`: poll_id, snapshot_at; `roster`: channel, broadcaster_id; `live`: poll_id, login,
    title, category, viewer_count, stream_started_at of the streams found. An offline channel
    keeps title, category and start of its last live poll and has no viewers or duration.
    """
    found = live.select(
        "poll_id",
        F.lower("login").alias("_login"),
        F.struct("title", "category", "stream_started_at").alias("_air"),
        F.col("viewer_count").alias("viewer_count"),
    )
    watched = each_with_all(polls, roster, "poll_id").withColumn("_login", F.lower("channel"))
    seen = watched.join(found, ["poll_id", "_login"], "left").withColumn("is_live", F.col("_air").isNotNull())
    seen = seen.withColumn(
        "duration_seconds",
        F.when(F.col("is_live"), seconds_between("_air.stream_started_at", "snapshot_at")),
    )
    cut = slice_hot_keys(seen, ["channel"], micros("snapshot_at"), settings)
    # The whole struct is carried, so a title that is null while live stays null.
    return last_known(cut, ["channel"], ["snapshot_at", "poll_id"], ["_air"]).select(
        "poll_id", "channel", "broadcaster_id", "is_live", "_air.title", "_air.category", "viewer_count",
        "duration_seconds", "_air.stream_started_at", "snapshot_at",
    )


def poll_summary(metadata: DataFrame) -> DataFrame:
    return metadata.groupBy("snapshot_at").agg(
        F.count_if("is_live").alias("live_count"),
        rows().alias("channel_count"),
        F.sum(F.coalesce("viewer_count", F.lit(0))).alias("total_viewers"),
    )


def stream_end_events(metadata: DataFrame, settings: Settings) -> DataFrame:
    """The first offline poll after a live one, per channel."""
    polls = metadata.select("channel", "snapshot_at", "id", "is_live")
    cut = slice_hot_keys(polls, ["channel"], micros("snapshot_at"), settings)
    ordered = previous_row(cut, ["channel"], ["snapshot_at", "id"], ["is_live"])
    return ordered.where(F.col("prev.is_live") & ~F.col("is_live")).select(
        "channel", F.col("snapshot_at").alias("stream_ended_at")
    )


def roster_additions(snapshots: DataFrame, known: DataFrame) -> DataFrame:
    """Logins never seen before and when they first appeared; nothing is ever removed."""
    return (
        snapshots.where(F.col("twitch_login").isNotNull())
        .groupBy(F.col("twitch_login").alias("channel"))
        .agg(F.min("ingested_at").alias("first_seen_at"))
        .join(known.select(F.lower("channel").alias("channel")).distinct(), "channel", "left_anti")
    )
