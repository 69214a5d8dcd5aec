"""Chat volume, mood, emotes and badges per channel."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamtally.functions import text
from streamtally.functions.ratio import ratio, rows, when_positive
from streamtally.functions.time import day_of, hour_of
from streamtally.operators.product import each_with_all
from streamtally.operators.ranking import rank_descending
from streamtally.schemas import GLOBAL_CHANNEL
from streamtally.settings import Settings


def hourly_activity(chat: DataFrame) -> DataFrame:
    return (
        chat.where(F.col("message_sent_at").isNotNull())
        .groupBy("channel", hour_of("message_sent_at").alias("hour_bucket"))
        .agg(rows().alias("message_count"), F.countDistinct("chatter_id").alias("unique_chatter_count"))
    )


def hourly_mood(chat: DataFrame, settings: Settings) -> DataFrame:
    """Five message-rate signals in one pass over the channel-hours busy enough to judge."""
    return (
        chat.where(F.col("message_sent_at").isNotNull())
        .groupBy("channel", hour_of("message_sent_at").alias("hour_bucket"))
        .agg(
            rows().alias("message_count"),
            text.share_of(F.col("message_text").contains("!!")).alias("punct_rate"),
            text.share_of(text.is_shouted("message_text")).alias("caps_rate"),
            text.share_of(text.starts_a_word("message_text", text.HYPE_STEMS)).alias("emote_rate"),
            text.share_of(text.starts_a_word("message_text", text.POSITIVE_STEMS)).alias("positive_rate"),
            text.share_of(text.starts_a_word("message_text", text.HOSTILE_STEMS)).alias("hostile_rate"),
        )
        .where(F.col("message_count") >= settings.mood_min_messages)
    )


def spikes(hourly: DataFrame, settings: Settings) -> DataFrame:
    """Hours in which a channel is far above its own norm. A channel has one row per
    hour here, so the window partition is bounded by the hours observed."""
    own = Window.partitionBy("channel")
    return (
        hourly.withColumn("channel_avg_message_count", F.avg("message_count").over(own))
        .withColumn("channel_stddev_message_count", F.stddev("message_count").over(own))
        .withColumn(
            "message_count_zscore",
            ratio(F.col("message_count") - F.col("channel_avg_message_count"), "channel_stddev_message_count"),
        )
        .where((F.col("channel_stddev_message_count") > 0) & (F.col("message_count_zscore") >= settings.spike_z))
    )


def emote_usage(chat: DataFrame, catalog: DataFrame, bucket: Callable[[str], Column] | None = hour_of, into: str = "hour_bucket") -> DataFrame:
    """Uses per (channel, hour, service, emote): the platform's own emotes from the
    message tag, those of the other services by exact token match against the catalog.

    Per `bucket` of the time sent instead of the hour, or over all time without one. A token is matched by every emote
    of its code, so the rows grow with buckets x catalog: coarser totals are counted from the messages, not from hours.
    """
    keys = ["channel", *([into] if bucket else [])]
    at = [bucket("message_sent_at").alias(into)] if bucket else []
    native = (
        chat.select("channel", *at, F.explode("emotes").alias("emote_id", "_uses"))
        .groupBy(*keys, "emote_id")
        .agg(F.sum("_uses").alias("usage_count"))
        .select(*keys, F.lit("twitch").alias("service"), "emote_id", "usage_count")
    )
    words = (
        chat.where(F.col("message_text") != "")
        .select("channel", *at, F.explode(text.tokens("message_text")).alias("_token"))
        .where(F.col("_token") != "")
    )
    # Fold repeats first: a popular token then costs one row per channel and bucket in the join.
    words = words.groupBy(*keys, "_token").agg(rows().alias("_n"))
    # A token is looked up twice, as the channel's own and as a global code: one equi-join over one pass instead of a
    # join on either condition. A channel named like the global scope has its tokens looked up once, counted twice.
    twice = F.when(F.col("channel") == GLOBAL_CHANNEL, F.col("_n") * 2).otherwise(F.col("_n"))
    owners = F.array_distinct(F.array(F.col("channel"), F.lit(GLOBAL_CHANNEL)))
    words = words.withColumn("_n", twice).withColumn("_owner", F.explode(owners))
    # Both sides are small and their matches are many: a fixed number of parts is not merged by its small size, and the
    # catalog, which compresses well, is not taken for small enough to broadcast.
    parts = int(chat.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = words.repartition(parts, "_owner", "_token").join(
        _codes(catalog).repartition(parts, "_owner", "_token").hint("merge"), ["_owner", "_token"]
    )
    matched = met.select(*keys, "service", "emote_id", (F.col("_n") * F.col("_times")).alias("usage_count"), "_alone")
    # An emote with one code for a channel has one match per word row, which is its total; only others are summed.
    final = matched.where("_alone").drop("_alone")
    summed = matched.where("not _alone").groupBy(*keys, "service", "emote_id").agg(F.sum("usage_count").alias("usage_count"))
    return native.unionByName(final).unionByName(summed)


def _codes(catalog: DataFrame) -> DataFrame:
    """Codes of the services that are matched by text, each with how often it is listed, and `_alone`: no channel can
    meet the emote by another code, its own or a global one."""
    codes = (
        catalog.where(F.col("service").isin("7tv", "bttv", "ffz") & F.col("channel").isNotNull() & F.col("emote_code").isNotNull())
        .groupBy("service", "emote_id", F.col("channel").alias("_owner"), F.col("emote_code").alias("_token"))
        .agg(rows().alias("_times"))
    )
    emote, owned = Window.partitionBy("service", "emote_id"), Window.partitionBy("service", "emote_id", "_owner")
    shared = F.col("_owner") == GLOBAL_CHANNEL
    mixed = F.max(shared).over(emote) & ~F.min(shared).over(emote)
    return codes.withColumn("_alone", (F.count(F.lit(1)).over(owned) == 1) & ~mixed)


def emote_catalog_coverage(chat: DataFrame, catalog: DataFrame, usage: DataFrame) -> DataFrame:
    """Every emote a channel could use, with how often it was used, from the totals per channel.

    The global emotes apply to each channel seen in chat.
    """
    channels = chat.select("channel").distinct()
    shared = catalog.where(F.col("scope") == "global").select("service", "emote_id")
    # The channels are the few that are repeated; the catalog is not.
    everywhere = each_with_all(shared, channels, "emote_id").select("channel", "service", "emote_id")
    own = catalog.where(F.col("scope") == "channel").select("channel", "service", "emote_id")
    used = usage.groupBy("channel", "service", "emote_id").agg(F.sum("usage_count").alias("_used"))
    return (
        own.unionByName(everywhere)
        .distinct()
        .join(used, ["channel", "service", "emote_id"], "left")
        .select(
            "channel", "service", "emote_id",
            F.coalesce("_used", F.lit(0)).alias("total_usage_count"),
            F.col("_used").isNotNull().alias("was_used"),
        )
    )


def emote_trends(usage: DataFrame, settings: Settings) -> DataFrame:
    """Rank of the daily uses. No catalog bounds the emotes of a channel-day, so no task orders all of them."""
    daily = usage.select("channel", "service", "emote_id", "day_bucket", "usage_count")
    return rank_descending(daily, ["channel", "day_bucket"], "usage_count", "rank_within_channel_day", settings, name="emote days")


def emote_catalog_utilization(coverage: DataFrame) -> DataFrame:
    return (
        coverage.groupBy("channel", "service")
        .agg(
            rows().alias("catalog_size"),
            F.count_if("was_used").alias("used_count"),
            F.sum("total_usage_count").alias("total_usage_count"),
        )
        .withColumn("utilization_pct", ratio("used_count", "catalog_size"))
    )


def engagement_vs_donations(hourly: DataFrame, deltas: DataFrame) -> DataFrame:
    donations = deltas.groupBy(
        F.col("twitch_login").alias("channel"), hour_of("ingested_at").alias("hour_bucket")
    ).agg(
        F.sum("donation_delta_eur").alias("donation_delta_eur"), F.avg("viewer_count").alias("avg_viewer_count")
    )
    per_minute = F.col("message_count") / F.lit(60.0)
    return hourly.join(donations, ["channel", "hour_bucket"], "left").select(
        "channel", "hour_bucket", "message_count", "unique_chatter_count", "donation_delta_eur", "avg_viewer_count",
        when_positive("avg_viewer_count", per_minute / (F.col("avg_viewer_count") / F.lit(100.0))).alias(
            "msgs_per_min_per_100_viewers"
        ),
    )


def new_chatters_per_channel(chatter_channels: DataFrame) -> DataFrame:
    return chatter_channels.groupBy("channel", day_of("first_message_at").alias("day_bucket")).agg(
        rows().alias("new_chatters_to_channel")
    )


def badge_and_verbosity(chat: DataFrame) -> DataFrame:
    def worn(badge: str):
        return F.map_contains_key("badges", badge)

    plain = F.col("badges").isNull() | (F.size("badges") == 0)
    length = F.length("message_text")
    return chat.groupBy("channel").agg(
        rows().alias("message_count"),
        F.count_if(worn("subscriber")).alias("subscriber_message_count"),
        F.count_if(worn("vip")).alias("vip_message_count"),
        F.count_if(worn("moderator")).alias("moderator_message_count"),
        F.count_if(plain).alias("plain_viewer_message_count"),
        F.avg(length).alias("avg_message_length"),
        F.avg(F.when(worn("subscriber"), length)).alias("avg_message_length_subscriber"),
        F.avg(F.when(plain, length)).alias("avg_message_length_plain_viewer"),
    )
