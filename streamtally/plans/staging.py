from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def chat(bronze: DataFrame) -> DataFrame:
    blank = F.lit("")
    return bronze.select(
        "id", "batch_id", "row_number", "channel", "chatter", "chatter_id", "message_text", "message_sent_at",
        "captured_at", "badges", "emotes", "account_created_at", "ingested_at",
        F.nullif("user_type", blank).alias("user_type"),
        F.nullif("broadcaster_type", blank).alias("broadcaster_type"),
    )


def metadata(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "id", "batch_id", "row_number", "channel", "broadcaster_id", "is_live", "title", "category",
        "viewer_count", "duration_seconds", "stream_started_at", "snapshot_at", "ingested_at",
    )


def snapshots(bronze: DataFrame) -> DataFrame:
    """One row per (snapshot, streamer); a snapshot without streamers leaves no row.

    The outer form with a filter behind it keeps the planner from testing the array in a
    filter of its own, which would parse it again where it comes from JSON.
    """
    return (
        bronze.select(
            F.col("id").alias("snapshot_id"), "batch_id", "row_number", "website_mode", "total_donation_amount_eur",
            "total_viewer_count", "ingested_at", F.posexplode_outer("streamers").alias("_at", "_s"),
        )
        .where(F.col("_at").isNotNull())
        .select(
            "snapshot_id", "batch_id", "row_number", "website_mode", "total_donation_amount_eur",
            "total_viewer_count", "ingested_at", "_s.twitch_id", F.lower("_s.twitch_login").alias("twitch_login"),
            "_s.display_name", "_s.profile_url", F.col("_s.online").alias("is_online"), "_s.game", "_s.viewer_count",
            "_s.donation_amount_eur",
        )
    )


def goals(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "participation_id", "streamer_name", "twitch_id", "goal_id", "goal_name", "goal_amount_eur",
        "goal_category", "snapshot_at", "ingested_at", F.lower("twitch_login").alias("twitch_login"),
    )


def emotes(bronze: DataFrame) -> DataFrame:
    return bronze.select("service", "scope", "channel", "emote_id", "emote_code", "fetched_at", "ingested_at")
