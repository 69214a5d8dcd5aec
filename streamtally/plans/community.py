"""Audience overlap and movement between channels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamtally.functions.ratio import ratio, rows
from streamtally.functions.time import hour_of
from streamtally.operators.pairs import shared_members
from streamtally.settings import Settings


def hourly_edges(chat: DataFrame) -> DataFrame:
    return (
        chat.where(F.col("chatter_id").isNotNull())
        .groupBy("chatter_id", "channel", hour_of("message_sent_at").alias("hour_bucket"))
        .agg(rows().alias("message_count"))
    )


def hourly_network(edges: DataFrame, settings: Settings) -> DataFrame:
    """Channel pairs with shared chatters, per hour, weighted by the smaller message count."""
    timed = edges.where(F.col("hour_bucket").isNotNull())
    return shared_members(timed, ["hour_bucket"], "chatter_id", "channel", "message_count", settings).select(
        "hour_bucket",
        F.col("node_a").alias("channel_a"),
        F.col("node_b").alias("channel_b"),
        F.col("shared").alias("shared_chatter_count"),
        F.col("overlap").alias("min_message_overlap"),
    )


def channel_pair_jaccard(chat: DataFrame, settings: Settings) -> DataFrame:
    members = (
        chat.where(F.col("chatter_id").isNotNull())
        .select("chatter_id", "channel")
        .distinct()
        .withColumn("_one", F.lit(1))
    )
    totals = members.groupBy("channel").agg(rows().alias("chatters"))
    pairs = shared_members(members, [], "chatter_id", "channel", "_one", settings)

    def total(node: str, column: str) -> DataFrame:
        return totals.select(F.col("channel").alias(node), F.col("chatters").alias(column))

    union = F.col("channel_a_chatter_count") + F.col("channel_b_chatter_count") - F.col("shared")
    return (
        pairs.join(total("node_a", "channel_a_chatter_count"), "node_a")
        .join(total("node_b", "channel_b_chatter_count"), "node_b")
        .select(
            F.col("node_a").alias("channel_a"),
            F.col("node_b").alias("channel_b"),
            F.col("shared").alias("shared_chatter_count"),
            "channel_a_chatter_count",
            "channel_b_chatter_count",
            ratio(F.col("shared"), union).alias("jaccard_index"),
        )
    )


def channel_network(jaccard: DataFrame, settings: Settings) -> DataFrame:
    return jaccard.where(F.col("shared_chatter_count") >= settings.network_min_shared)


def chatter_migrations(hops: DataFrame) -> DataFrame:
    return hops.groupBy("from_channel", "to_channel").agg(
        rows().alias("hop_count"),
        F.countDistinct("chatter_id").alias("distinct_chatters_hopping"),
        F.avg("gap_seconds").alias("avg_gap_seconds"),
    )


def peer_chat(chat: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Messages a streamer of the event wrote in somebody else's channel."""
    roster = (
        snapshots.where(F.col("twitch_login").isNotNull())
        .select(F.col("twitch_login").alias("supporting_streamer_login"))
        .distinct()
    )
    written = chat.where(F.col("chatter_id").isNotNull()).select(
        "chatter_id",
        F.lower("chatter").alias("supporting_streamer_login"),
        F.col("channel").alias("supported_channel"),
        "message_sent_at",
    )
    return written.where(F.col("supporting_streamer_login") != F.col("supported_channel")).join(
        roster, "supporting_streamer_login", "left_semi"
    )


def support_network(peer: DataFrame) -> DataFrame:
    return peer.groupBy("supporting_streamer_login", "supported_channel").agg(
        rows().alias("message_count"),
        F.min("message_sent_at").alias("first_message_at"),
        F.max("message_sent_at").alias("last_message_at"),
    )
