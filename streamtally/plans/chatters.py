"""Who the chatters are: breadth, rhythm, age, retention.

Profile, account age, breadth and the enriched table all come from one two-step
rollup (chatter x channel, then chatter), so none of them joins the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamtally.functions.ratio import ratio, rows
from streamtally.functions.text import has_long_digit_suffix
from streamtally.functions.time import day_of, hour_of, plus_seconds, quarter_hour_of, seconds_between
from streamtally.operators.ordered import micros, order_key, previous_row, slice_hot_keys, uncut
from streamtally.operators.ranking import rank_descending
from streamtally.settings import Settings
from streamtally.sources.table_log import Table
from streamtally.sources.table_log import day_of as days_since_1970

DAY_MICROS = 86_400_000_000


def channel_activity(chat: DataFrame) -> DataFrame:
    return (
        chat.where(F.col("chatter_id").isNotNull())
        .groupBy("chatter_id", "channel")
        .agg(
            rows().alias("message_count"),
            F.min("message_sent_at").alias("first_message_at"),
            F.max("message_sent_at").alias("last_message_at"),
            F.countDistinct(hour_of("message_sent_at")).alias("active_hours"),
        )
    )


def rollup(chat: DataFrame) -> DataFrame:
    """One row per chatter with everything the chatter marts project from.

    Identity comes from the latest message; a message without a time sorts last,
    that is, it counts as the latest.
    """
    identity = F.struct("chatter", "account_created_at", "broadcaster_type")
    latest = order_key(["message_sent_at", "id"])
    length = F.length("message_text").cast("long")
    per_channel = (
        chat.where(F.col("chatter_id").isNotNull())
        .groupBy("chatter_id", "channel")
        .agg(
            rows().alias("_n"),
            F.min("message_sent_at").alias("_first"),
            F.max("message_sent_at").alias("_last"),
            F.sum(length).alias("_chars"),
            F.count(length).alias("_texts"),
            F.max(latest).alias("_at"),
            F.max_by(identity, latest).alias("_who"),
        )
    )
    return (
        per_channel.groupBy("chatter_id")
        .agg(
            F.count("channel").alias("distinct_channel_count"),
            F.sum("_n").alias("total_message_count"),
            F.max("_n").alias("max_channel_message_count"),
            F.min("_first").alias("first_message_at"),
            F.max("_last").alias("last_message_at"),
            ratio(F.sum("_chars"), F.sum("_texts")).alias("avg_message_length"),
            F.max_by("_who", "_at").alias("_who"),
        )
        .select("*", "_who.*")
        .drop("_who")
        .withColumn("lifespan_seconds", seconds_between("first_message_at", "last_message_at"))
        .withColumn("has_long_digit_suffix", has_long_digit_suffix("chatter"))
    )


def activity(rolled: DataFrame) -> DataFrame:
    return rolled.select(
        "chatter_id", "chatter", "account_created_at", "broadcaster_type", "distinct_channel_count",
        "total_message_count", "first_message_at", "last_message_at", "avg_message_length", "lifespan_seconds",
        "has_long_digit_suffix",
    )


def profile_label(channels: str, settings: Settings) -> Column:
    n = F.col(channels)
    return (
        F.when(n <= settings.sedentary_max_channels, "sedentaire")
        .when(n <= settings.multi_streamer_max_channels, "multi_streamer")
        .when(n <= settings.semi_nomad_max_channels, "semi_nomade")
        .otherwise("nomade")
    )


def age_label(created: str, settings: Settings) -> Column:
    at, now = F.col(created), F.lit(settings.as_of)
    return (
        F.when(at.isNull(), None)
        .when(at >= now - F.expr("interval 30 days"), "new (<30d)")
        .when(at >= now - F.expr("interval 1 year"), "1mo-1yr")
        .when(at >= now - F.expr("interval 3 years"), "1-3yr")
        .otherwise("3yr+")
    )


def _profile_columns(settings: Settings) -> list:
    return [
        "distinct_channel_count", "total_message_count", "max_channel_message_count",
        ratio("max_channel_message_count", "total_message_count").alias("top_channel_share"),
        profile_label("distinct_channel_count", settings).alias("chatter_profile"),
    ]


def _breadth_columns() -> list:
    # Rounded as decimals, half away from zero.
    per_channel = F.col("total_message_count").cast("decimal(28,10)") / F.col("distinct_channel_count")
    hours = F.col("lifespan_seconds").cast("decimal(28,6)") / F.lit(3600)
    return [
        "first_message_at", "last_message_at", "lifespan_seconds",
        F.round(per_channel, 1).cast("double").alias("avg_messages_per_channel"),
        F.round(hours, 1).cast("double").alias("lifespan_hours"),
    ]


_RHYTHM = ["gap_count", "avg_gap_seconds", "stddev_gap_seconds", "gap_coefficient_of_variation"]


def profile(rolled: DataFrame, settings: Settings) -> DataFrame:
    return rolled.select("chatter_id", "chatter", *_profile_columns(settings))


def account_age_profile(rolled: DataFrame, settings: Settings) -> DataFrame:
    return rolled.select(
        "chatter_id", "chatter", "account_created_at",
        profile_label("distinct_channel_count", settings).alias("chatter_profile"),
        "distinct_channel_count",
        age_label("account_created_at", settings).alias("account_age_bucket"),
    )


def breadth_depth_lifespan(rolled: DataFrame) -> DataFrame:
    return rolled.select(
        "chatter_id", "chatter", "distinct_channel_count", "total_message_count", *_breadth_columns()
    )


def timeline(chat: DataFrame, settings: Settings) -> DataFrame:
    """A chatter's messages in order across channels, each with the one before it."""
    said = chat.where(F.col("chatter_id").isNotNull() & F.col("message_sent_at").isNotNull()).select(
        "chatter_id", "channel", "message_sent_at", "id"
    )
    cut = slice_hot_keys(said, ["chatter_id"], micros("message_sent_at"), settings, name="messages", ties=["id"])
    return uncut(previous_row(cut, ["chatter_id"], ["message_sent_at", "id"], ["channel", "message_sent_at"]))


def inter_arrival(ordered: DataFrame) -> DataFrame:
    return ordered.select(
        "chatter_id", "channel", "message_sent_at",
        seconds_between("prev.message_sent_at", "message_sent_at").alias("inter_arrival_seconds"),
    )


def channel_hops(ordered: DataFrame, settings: Settings) -> DataFrame:
    gap = seconds_between("prev.message_sent_at", "message_sent_at")
    return ordered.where(
        (F.col("channel") != F.col("prev.channel")) & (gap <= settings.hop_max_gap_minutes * 60)
    ).select(
        "chatter_id",
        F.col("prev.channel").alias("from_channel"),
        F.col("channel").alias("to_channel"),
        F.col("prev.message_sent_at").alias("departed_at"),
        F.col("message_sent_at").alias("arrived_at"),
        gap.alias("gap_seconds"),
    )


def regularity(gaps: DataFrame, settings: Settings) -> DataFrame:
    return (
        gaps.where(F.col("inter_arrival_seconds").isNotNull())
        .groupBy("chatter_id")
        .agg(
            rows().alias("gap_count"),
            F.avg("inter_arrival_seconds").alias("avg_gap_seconds"),
            F.stddev("inter_arrival_seconds").alias("stddev_gap_seconds"),
        )
        .where(F.col("gap_count") >= settings.bot_min_gaps)
        .withColumn(
            "gap_coefficient_of_variation",
            F.when(F.col("avg_gap_seconds") > 0, F.col("stddev_gap_seconds") / F.col("avg_gap_seconds")),
        )
    )


def bot_signal(rolled: DataFrame, rhythm: DataFrame) -> DataFrame:
    return rolled.join(rhythm, "chatter_id", "left").select(
        "chatter_id", "chatter", "account_created_at", "has_long_digit_suffix", "total_message_count", *_RHYTHM
    )


def enriched(rolled: DataFrame, rhythm: DataFrame, settings: Settings) -> DataFrame:
    return rolled.join(rhythm, "chatter_id", "left").select(
        "chatter_id", "chatter", *_profile_columns(settings), "account_created_at",
        age_label("account_created_at", settings).alias("account_age_bucket"),
        "has_long_digit_suffix", *_RHYTHM, *_breadth_columns(),
    )


def leaderboard(channels: DataFrame, rolled: DataFrame, settings: Settings) -> DataFrame:
    totals = rolled.select("chatter_id", "chatter", "distinct_channel_count", "total_message_count")
    in_channel = channels.groupBy("channel", "message_count").agg(rows().alias("_rows"))
    # A chatter stands on as many rows as it has channels, and each of them counts.
    overall = totals.groupBy("total_message_count").agg(F.sum("distinct_channel_count").alias("_rows"))
    # The totals are ranked before they meet the channels, where each would be many rows.
    placed = rank_descending(totals, [], "total_message_count", "rank_global", settings, overall, "chatter totals")
    joined = channels.join(placed, "chatter_id")
    return rank_descending(joined, ["channel"], "message_count", "rank_within_channel", settings, in_channel, "channel totals").select(
        "chatter_id", "chatter", "channel", "message_count", "active_hours", "first_message_at", "last_message_at",
        "distinct_channel_count", "total_message_count", "rank_within_channel", "rank_global",
    )


def top_in_channel(board: DataFrame, channel: str, n: int) -> DataFrame:
    return board.where(F.col("channel") == channel).orderBy("rank_within_channel", "chatter_id").limit(n)


def _one_row_per_chatter(board: DataFrame) -> DataFrame:
    return board.groupBy("chatter_id").agg(
        F.max("chatter").alias("chatter"),
        F.max("distinct_channel_count").alias("distinct_channel_count"),
        F.max("total_message_count").alias("total_message_count"),
        F.max("rank_global").alias("rank_global"),
    )


def top_breadth(board: DataFrame, n: int) -> DataFrame:
    return (
        _one_row_per_chatter(board)
        .orderBy(F.desc("distinct_channel_count"), F.desc("total_message_count"), "chatter_id")
        .limit(n)
    )


def top_event(board: DataFrame, n: int) -> DataFrame:
    return _one_row_per_chatter(board).orderBy("rank_global", "chatter_id").limit(n)


def quarter_hours(chat: DataFrame) -> DataFrame:
    return (
        chat.where(F.col("chatter_id").isNotNull() & F.col("message_sent_at").isNotNull())
        .groupBy("chatter_id", quarter_hour_of("message_sent_at").alias("quarter_hour_bucket"))
        .agg(F.countDistinct("channel").alias("distinct_channel_count"), rows().alias("message_count"))
    )


def refresh_quarter_hours(existing: DataFrame, chat: DataFrame, settings: Settings) -> DataFrame:
    """The table after an incremental run: messages from one bucket before the newest
    known bucket on are counted again, and their (chatter, bucket) rows replace the old."""
    newest = existing.agg(F.max("quarter_hour_bucket").alias("newest"))
    origin = F.lit("2000-01-01 00:00:00").cast("timestamp")
    lookback = -60 * settings.quarter_hour_lookback_minutes
    since = newest.select(plus_seconds(F.coalesce("newest", origin), lookback)).scalar()
    fresh = quarter_hours(chat.where(F.col("message_sent_at") >= since))
    kept = existing.join(fresh, ["chatter_id", "quarter_hour_bucket"], "left_anti")
    return kept.unionByName(fresh)


def quarter_hour_table(spark: SparkSession, path: str) -> Table:
    columns = "chatter_id string, quarter_hour_bucket timestamp, distinct_channel_count bigint, message_count bigint"
    return Table(spark, path, columns, "quarter_hour_bucket", bucket=days_since_1970("quarter_hour_bucket"))


def store_quarter_hours(table: Table, chat: DataFrame, settings: Settings) -> list[int]:
    """An incremental run of `refresh_quarter_hours` on a stored table: only the days from the lookback on are read
    and rewritten, in one commit. Returns those days. A run that failed has no effect and is simply run again."""
    manifest = table.manifest()
    newest = max((p.high for p in manifest.parts if p.high is not None), default=None)
    if newest is None:
        first, existing = None, table.read(buckets=[])
    else:
        first = (newest - settings.quarter_hour_lookback_minutes * 60_000_000) // DAY_MICROS
        existing = table.read(buckets={p.bucket for p in manifest.parts if p.bucket >= first})
    after = refresh_quarter_hours(existing, chat, settings)
    return sorted(p.bucket for p in table.replace(after, manifest.epoch + 1))


def retention(quarters: DataFrame, rolled: DataFrame) -> DataFrame:
    """Presence per bucket. A chatter has one row per bucket, which bounds the window."""
    own = Window.partitionBy("chatter_id")
    names = rolled.select("chatter_id", "chatter")
    return (
        quarters.withColumn("first_active_quarter_hour", F.min("quarter_hour_bucket").over(own))
        .withColumn("total_quarter_hours_active", F.count(F.lit(1)).over(own))
        .join(names, "chatter_id", "left")
        .select(
            "chatter_id", "chatter", "quarter_hour_bucket", "distinct_channel_count", "message_count",
            "first_active_quarter_hour",
            (F.col("quarter_hour_bucket") == F.col("first_active_quarter_hour")).alias("is_new_this_quarter_hour"),
            "total_quarter_hours_active",
        )
    )


def retention_curve(quarters: DataFrame) -> DataFrame:
    own = Window.partitionBy("chatter_id")
    days = quarters.select("chatter_id", day_of("quarter_hour_bucket").alias("_day")).distinct()
    per_day = (
        days.withColumn("day_index", F.datediff("_day", F.min("_day").over(own)))
        .groupBy("day_index")
        .agg(rows().alias("active_chatter_count"))
    )
    # One row per day of the event from here on.
    first = Window.orderBy("day_index")
    return per_day.withColumn("cohort_size", F.first("active_chatter_count").over(first)).withColumn(
        "retention_pct", ratio("active_chatter_count", "cohort_size")
    )
