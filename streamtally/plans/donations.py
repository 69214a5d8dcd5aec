"""Donation velocity, ranks, goals and their reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamtally.functions.ratio import ratio, rows, when_positive
from streamtally.functions.time import day_of, hour_of, seconds_between
from streamtally.operators.asof import asof_join
from streamtally.operators.latest import latest_per_key
from streamtally.operators.ordered import micros, previous_row, slice_hot_keys
from streamtally.operators.ranking import rank_descending
from streamtally.schemas import MONEY
from streamtally.settings import Settings

_POLL_ORDER = ["ingested_at", "snapshot_id"]


def deltas(snapshots: DataFrame, settings: Settings) -> DataFrame:
    """What came in between two polls of a streamer's running total."""
    named = snapshots.where(F.col("twitch_login").isNotNull())
    cut = slice_hot_keys(named, ["twitch_login"], micros("ingested_at"), settings, name="donations", ties=["snapshot_id"])
    ordered = previous_row(cut, ["twitch_login"], _POLL_ORDER, ["donation_amount_eur", "ingested_at"])
    moved = F.col("donation_amount_eur") - F.col("prev.donation_amount_eur")
    return ordered.select(
        "snapshot_id", "twitch_login", "display_name", "game", "is_online", "viewer_count", "donation_amount_eur",
        "total_donation_amount_eur", "total_viewer_count", "ingested_at",
        F.col("prev.ingested_at").alias("prev_ingested_at"),
        F.coalesce(moved, F.lit(0)).cast(MONEY).alias("donation_delta_eur"),
        seconds_between("prev.ingested_at", "ingested_at").alias("seconds_since_prev_snapshot"),
    )


def timeseries(moves: DataFrame) -> DataFrame:
    seconds = F.col("seconds_since_prev_snapshot")
    return moves.select(
        "twitch_login", "display_name", "game", "is_online", "viewer_count", "donation_amount_eur",
        "donation_delta_eur", "total_donation_amount_eur", "total_viewer_count", "ingested_at",
        "seconds_since_prev_snapshot",
        day_of("ingested_at").alias("day_bucket"),
        when_positive(seconds, F.col("donation_delta_eur").cast("double") / (seconds / F.lit(60.0))).alias(
            "donation_velocity_eur_per_min"
        ),
    )


def hourly_last(moves: DataFrame) -> DataFrame:
    return latest_per_key(
        moves.withColumn("hour_bucket", hour_of("ingested_at")),
        ["twitch_login", "hour_bucket"], _POLL_ORDER, ["display_name", "donation_amount_eur"],
    )


def rank(snapshots: DataFrame, settings: Settings) -> DataFrame:
    """Rank of each streamer within a poll and its change since the streamer's last poll."""
    named = snapshots.where(F.col("twitch_login").isNotNull()).select(
        "snapshot_id", "twitch_login", "display_name", "ingested_at", "donation_amount_eur"
    )
    ranked = rank_descending(named, ["ingested_at"], "donation_amount_eur", "donation_rank", settings, name="donation levels")
    cut = slice_hot_keys(ranked, ["twitch_login"], micros("ingested_at"), settings, extent_of=named, name="donations", ties=["snapshot_id"])
    return previous_row(cut, ["twitch_login"], _POLL_ORDER, ["donation_rank"]).select(
        "snapshot_id", "twitch_login", "display_name", "ingested_at", "donation_amount_eur", "donation_rank",
        F.col("prev.donation_rank").alias("prev_donation_rank"),
        (F.col("donation_rank") - F.col("prev.donation_rank")).alias("rank_change"),
    )


def rank_hourly(ranks: DataFrame) -> DataFrame:
    return latest_per_key(
        ranks.withColumn("hour_bucket", hour_of("ingested_at")),
        ["twitch_login", "hour_bucket"], _POLL_ORDER,
        ["display_name", "donation_rank", "prev_donation_rank", "rank_change"],
    )


def rank_churn(ranks: DataFrame, settings: Settings) -> DataFrame:
    return ranks.select(
        "twitch_login", "display_name", "ingested_at", "donation_rank", "prev_donation_rank", "rank_change",
        (F.col("donation_rank") <= settings.leaderboard_top).alias("in_top_10"),
    )


def by_title(moves: DataFrame, metadata: DataFrame, settings: Settings) -> DataFrame:
    gained = moves.where(F.col("donation_delta_eur") > 0).select(
        "twitch_login", "display_name", "ingested_at", "donation_delta_eur"
    )
    return asof_join(
        gained, metadata.select("channel", "snapshot_at", "id", "title", "category"),
        "twitch_login", "ingested_at", "channel", "snapshot_at", "id", ["title", "category"],
        settings.asof_lookback_seconds, settings, name="gains and titles",
    ).select(
        "twitch_login", "display_name", "ingested_at", "donation_delta_eur", "match.title", "match.category"
    )


def spike_moments(moves: DataFrame, metadata: DataFrame, chat_hourly: DataFrame, settings: Settings) -> DataFrame:
    """The largest single gains, with what was on air and how loud chat was.

    The limit comes first, so everything else joins a table of at most `top_spikes`
    rows: that bound is what allows the broadcasts.
    """
    top = (
        moves.where(F.col("donation_delta_eur") > 0)
        .select("twitch_login", "display_name", "ingested_at", "donation_delta_eur", "snapshot_id")
        .orderBy(F.desc("donation_delta_eur"), "ingested_at", "twitch_login", "snapshot_id")
        .limit(settings.top_spikes)
    )
    spot = F.struct("twitch_login", "ingested_at", "snapshot_id")
    small = F.broadcast(top.select(spot.alias("_spot")))
    lookback = F.lit(settings.asof_lookback_seconds * 1_000_000)
    age = F.unix_micros("_spot.ingested_at") - F.unix_micros("snapshot_at")
    on_air = (
        metadata.join(small, F.col("channel") == F.col("_spot.twitch_login"))
        .where((age >= 0) & (age <= lookback))
        .groupBy("_spot")
        .agg(F.max_by(F.struct("title", "category"), F.struct("snapshot_at", "id")).alias("_on_air"))
    )
    # Only the channel-hours of the spikes are needed from chat.
    loud = chat_hourly.join(
        F.broadcast(top.select(F.col("twitch_login").alias("channel"), hour_of("ingested_at").alias("hour_bucket"))),
        ["channel", "hour_bucket"], "left_semi",
    ).select(
        F.col("channel").alias("twitch_login"), F.col("hour_bucket").alias("_hour"),
        F.col("message_count").alias("chat_messages_that_hour"),
    )
    return (
        top.withColumn("_spot", spot)
        .withColumn("_hour", hour_of("ingested_at"))
        .join(on_air, "_spot", "left")
        .join(loud, ["twitch_login", "_hour"], "left")
        .select(
            "twitch_login", "display_name", "ingested_at", "donation_delta_eur", "_on_air.title", "_on_air.category",
            "chat_messages_that_hour",
        )
    )


def normalized(moves: DataFrame, chatter_channels: DataFrame) -> DataFrame:
    totals = moves.groupBy("twitch_login").agg(
        F.max("donation_amount_eur").alias("latest_donation_amount_eur"),
        F.avg("viewer_count").alias("avg_viewer_count"),
    )
    audience = chatter_channels.groupBy(F.col("channel").alias("twitch_login")).agg(
        rows().alias("unique_chatter_count")
    )
    return (
        totals.join(audience, "twitch_login", "left")
        .withColumn("donation_eur_per_avg_viewer", ratio("latest_donation_amount_eur", "avg_viewer_count"))
        .withColumn("donation_eur_per_unique_chatter", ratio("latest_donation_amount_eur", "unique_chatter_count"))
    )


def reconciliation(snapshots: DataFrame) -> DataFrame:
    """The event's own total against the sum over its streamers, unnamed ones included."""
    return (
        snapshots.groupBy("snapshot_id", "ingested_at")
        .agg(
            F.max("total_donation_amount_eur").alias("total_donation_amount_eur"),
            F.sum("donation_amount_eur").alias("sum_of_streamer_donations_eur"),
        )
        .withColumn(
            "divergence_eur",
            F.col("total_donation_amount_eur") - F.col("sum_of_streamer_donations_eur").cast("double"),
        )
    )


def _goal_totals(goals: DataFrame) -> DataFrame:
    return goals.groupBy("twitch_login").agg(
        rows().alias("goal_count_for_streamer"),
        F.sum("goal_amount_eur").cast(MONEY).alias("total_goal_amount_eur_for_streamer"),
    )


def goals_current(goals: DataFrame) -> DataFrame:
    """Goals with their streamer's count and total, from an aggregate joined back rather
    than a window, so a streamer with very many goals is not gathered in one task."""
    totals = _goal_totals(goals).withColumnRenamed("twitch_login", "_login")
    return goals.join(totals, F.col("twitch_login").eqNullSafe(F.col("_login"))).select(
        "participation_id", "streamer_name", "twitch_login", "twitch_id", "goal_id", "goal_name", "goal_amount_eur",
        "goal_category", "snapshot_at", "goal_count_for_streamer", "total_goal_amount_eur_for_streamer",
    )


def goals_by_category(goals: DataFrame) -> DataFrame:
    return goals.groupBy("goal_category").agg(
        rows().alias("goal_count"),
        F.countDistinct("twitch_login").alias("streamer_count"),
        F.sum("goal_amount_eur").cast(MONEY).alias("total_goal_amount_eur"),
        F.avg(F.col("goal_amount_eur").cast("double")).alias("avg_goal_amount_eur"),
    )


def goal_vs_reality(goals: DataFrame, moves: DataFrame) -> DataFrame:
    raised = moves.groupBy("twitch_login").agg(F.max("donation_amount_eur").alias("latest_donation_amount_eur"))
    return _goal_totals(goals).join(raised, "twitch_login").select(
        "twitch_login", "total_goal_amount_eur_for_streamer", "latest_donation_amount_eur",
        (F.col("latest_donation_amount_eur") - F.col("total_goal_amount_eur_for_streamer")).alias("surplus_eur"),
        ratio("latest_donation_amount_eur", "total_goal_amount_eur_for_streamer").alias("pct_of_goals_covered"),
    )
