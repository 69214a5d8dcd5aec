"""Broadcasts: viewership, sessions, what was on air, liveness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamtally.functions.ratio import ratio, rows
from streamtally.functions.time import hour_of, plus_seconds, seconds_between
from streamtally.operators.asof import asof_join
from streamtally.operators.intervals import points_in_spans
from streamtally.operators.ordered import SLICES, micros, next_row, order_key, previous_row, running_sum, slice_hot_keys, uncut
from streamtally.settings import Settings

_POLL_ORDER = ["snapshot_at", "id"]


def hourly_viewership(metadata: DataFrame) -> DataFrame:
    return metadata.groupBy("channel", hour_of("snapshot_at").alias("hour_bucket")).agg(
        F.avg("viewer_count").alias("avg_viewer_count"),
        F.max("viewer_count").alias("peak_viewer_count"),
        F.count_if("is_live").alias("live_snapshot_count"),
        rows().alias("total_snapshot_count"),
    )


def viewership_timeseries(hourly: DataFrame) -> DataFrame:
    """Live hours with the channel's rank; an hour holds one row per channel."""
    at_hour = Window.partitionBy("hour_bucket").orderBy(F.col("avg_viewer_count").desc_nulls_first())
    return hourly.where(F.col("live_snapshot_count") > 0).withColumn("viewer_rank_at_hour", F.rank().over(at_hour))


def concurrency(hourly: DataFrame) -> DataFrame:
    live = F.col("live_snapshot_count") > 0
    return hourly.groupBy("hour_bucket").agg(
        F.count_if(live).alias("live_channel_count"),
        F.sum(F.when(live, F.col("avg_viewer_count"))).alias("total_avg_viewer_count"),
    )


def concurrency_vs_performance(hourly: DataFrame, at_once: DataFrame) -> DataFrame:
    return hourly.where(F.col("live_snapshot_count") > 0).join(at_once, "hour_bucket").select(
        "channel", "hour_bucket", "avg_viewer_count", "live_channel_count", "total_avg_viewer_count"
    )


def sessions(metadata: DataFrame) -> DataFrame:
    """One row per broadcast, told apart by the start time the platform reports."""
    return (
        metadata.where(F.col("is_live") & F.col("stream_started_at").isNotNull())
        .groupBy("channel", "broadcaster_id", "stream_started_at")
        .agg(
            F.min("snapshot_at").alias("first_seen_at"),
            F.max("snapshot_at").alias("last_seen_at"),
            F.max("duration_seconds").alias("duration_seconds"),
            F.avg("viewer_count").alias("avg_viewer_count"),
            F.max("viewer_count").alias("peak_viewer_count"),
        )
    )


def session_gaps(broadcasts: DataFrame, settings: Settings) -> DataFrame:
    cut = slice_hot_keys(broadcasts, ["channel"], micros("stream_started_at"), settings, name="sessions", ties=["broadcaster_id"])
    ordered = next_row(cut, ["channel"], ["stream_started_at", "broadcaster_id"], ["stream_started_at"])
    return ordered.select(
        "channel", "broadcaster_id", "stream_started_at", "last_seen_at",
        F.col("next.stream_started_at").alias("next_session_started_at"),
        seconds_between("last_seen_at", "next.stream_started_at").alias("gap_before_next_session_seconds"),
    )


def _on_air(metadata: DataFrame, settings: Settings) -> DataFrame:
    """Live polls in order, each with the live poll before it and whether title or
    category differ from it (null-safe). A first poll counts unless both are null."""
    live = metadata.where("is_live").select(
        "channel", "broadcaster_id", "title", "category", "viewer_count", "snapshot_at", "id"
    )
    cut = slice_hot_keys(live, ["channel"], micros("snapshot_at"), settings, name="live polls", ties=["id"])
    ordered = previous_row(cut, ["channel"], _POLL_ORDER, ["title", "category", "viewer_count"])
    same = F.col("title").eqNullSafe(F.col("prev.title")) & F.col("category").eqNullSafe(F.col("prev.category"))
    return ordered.withColumn("_changed", ~same)


def category_changes(metadata: DataFrame, settings: Settings) -> DataFrame:
    return _on_air(metadata, settings).where("_changed").select(
        "channel", "broadcaster_id",
        F.col("snapshot_at").alias("changed_at"),
        F.col("prev.category").alias("prev_category"),
        F.col("category").alias("new_category"),
        F.col("prev.title").alias("prev_title"),
        F.col("title").alias("new_title"),
        F.col("prev.viewer_count").alias("prev_viewer_count"),
        F.col("viewer_count").alias("viewer_count_at_change"),
    )


def title_segments(metadata: DataFrame, settings: Settings) -> DataFrame:
    marked = _on_air(metadata, settings).withColumn("_step", F.col("_changed").cast("long"))
    in_order = [F.col(c).asc_nulls_last() for c in _POLL_ORDER]
    return (
        running_sum(marked, ["channel"], in_order, "_step", "segment_id")
        .groupBy("channel", "broadcaster_id", "segment_id", "title", "category")
        .agg(
            F.min("snapshot_at").alias("segment_started_at"),
            F.max("snapshot_at").alias("segment_ended_at"),
            rows().alias("snapshot_count"),
            F.avg("viewer_count").alias("avg_viewer_count"),
            F.max("viewer_count").alias("max_viewer_count"),
        )
    )


def mode_changes(snapshots: DataFrame, settings: Settings) -> DataFrame:
    """Changes of the event site's own mode."""
    return uncut(sliced_mode_changes(snapshots, settings))


def sliced_mode_changes(snapshots: DataFrame, settings: Settings) -> DataFrame:
    """The same with the slices of the polls, for further sequences over them. The sequence is event-wide, so it
    has no key to partition by; it is cut into time slices once it is long."""
    polls = snapshots.select(
        "snapshot_id", "ingested_at", "website_mode", "total_donation_amount_eur", "total_viewer_count"
    ).distinct()
    cut = slice_hot_keys(polls, [], micros("ingested_at"), settings, name="event polls", ties=["snapshot_id"])
    ordered = previous_row(cut, [], ["ingested_at", "snapshot_id"], ["website_mode"])
    return ordered.where(~F.col("website_mode").eqNullSafe(F.col("prev.website_mode"))).select(
        "snapshot_id", F.col("ingested_at").alias("changed_at"),
        F.col("prev.website_mode").alias("prev_website_mode"),
        F.col("website_mode").alias("new_website_mode"),
        "total_donation_amount_eur", "total_viewer_count", *SLICES,
    )


def category_timeline(changes: DataFrame, hourly: DataFrame) -> DataFrame:
    after = hourly.select(
        "channel", F.col("hour_bucket").alias("_hour"), F.col("avg_viewer_count").alias("avg_viewer_count_hour_after")
    )
    return (
        changes.withColumn("_hour", plus_seconds(hour_of("changed_at"), 3600))
        .join(after, ["channel", "_hour"], "left")
        .select(
            "channel", "broadcaster_id", "changed_at", "prev_category", "new_category", "prev_title", "new_title",
            "viewer_count_at_change", "avg_viewer_count_hour_after",
        )
    )


def category_cooccurrence(metadata: DataFrame) -> DataFrame:
    return (
        metadata.where(F.col("is_live") & F.col("category").isNotNull())
        .groupBy("category", hour_of("snapshot_at").alias("hour_bucket"))
        .agg(F.countDistinct("channel").alias("channel_count_playing"))
    )


def session_analysis(
    metadata: DataFrame, broadcasts: DataFrame, chat: DataFrame, moves: DataFrame, settings: Settings
) -> DataFrame:
    session = ["channel", "stream_started_at"]
    edges = (
        metadata.where(F.col("is_live") & F.col("stream_started_at").isNotNull())
        .groupBy(*session)
        .agg(
            F.min_by(F.struct("viewer_count"), order_key(_POLL_ORDER)).alias("_first"),
            F.max_by(F.struct("viewer_count"), order_key(_POLL_ORDER)).alias("_last"),
        )
        .select(
            *session,
            F.col("_first.viewer_count").alias("viewer_count_at_start"),
            F.col("_last.viewer_count").alias("viewer_count_at_end"),
        )
    )
    spans = broadcasts.select(*session, "first_seen_at", "last_seen_at")

    def inside(points: DataFrame, ts: str) -> DataFrame:
        return points_in_spans(points, spans, "channel", ts, "first_seen_at", "last_seen_at", settings)

    # Twice the offset against the whole length: no half microseconds.
    early = 2 * (F.unix_micros("message_sent_at") - F.unix_micros("first_seen_at")) < (
        F.unix_micros("last_seen_at") - F.unix_micros("first_seen_at")
    )
    talk = (
        inside(chat.select("channel", "message_sent_at"), "message_sent_at")
        .groupBy(*session)
        .agg(
            F.count_if(early).alias("message_count_first_half"),
            F.count_if(~early).alias("message_count_second_half"),
        )
    )
    gifts = (
        inside(moves.select(F.col("twitch_login").alias("channel"), "ingested_at", "donation_delta_eur"), "ingested_at")
        .groupBy(*session)
        .agg(F.sum("donation_delta_eur").alias("donation_delta_during_session"))
    )
    return (
        broadcasts.join(edges, session, "left")
        .join(talk, session, "left")
        .join(gifts, session, "left")
        .select(
            "channel", "broadcaster_id", "stream_started_at", "duration_seconds", "avg_viewer_count",
            "peak_viewer_count", "viewer_count_at_start", "viewer_count_at_end", "message_count_first_half",
            "message_count_second_half", "donation_delta_during_session",
            duration_bucket("duration_seconds").alias("duration_bucket_index"),
            (F.col("viewer_count_at_end") - F.col("viewer_count_at_start")).alias("viewer_change"),
        )
    )


def duration_bucket(seconds: str) -> Column:
    """Twelve one-hour buckets; 12 hours and more fall into the overflow bucket 13."""
    return F.width_bucket(F.col(seconds), F.lit(0.0), F.lit(43200.0), F.lit(12)).cast("int")


def liveness_reconciliation(snapshots: DataFrame, metadata: DataFrame, settings: Settings) -> DataFrame:
    claims = snapshots.select("twitch_login", "snapshot_id", "ingested_at", "is_online")
    matched = asof_join(
        claims, metadata.select("channel", "snapshot_at", "id", "is_live"),
        "twitch_login", "ingested_at", "channel", "snapshot_at", "id", ["is_live"],
        settings.asof_lookback_seconds, settings, name="claims and polls",
    )
    return matched.select(
        "twitch_login", "snapshot_id",
        F.col("ingested_at").alias("event_snapshot_at"),
        F.col("is_online").alias("event_reported_online"),
        F.col("match.is_live").alias("helix_reported_live"),
        F.col("match.snapshot_at").alias("helix_snapshot_at"),
        (F.col("match.snapshot_at").isNotNull() & ~F.col("is_online").eqNullSafe(F.col("match.is_live"))).alias(
            "liveness_mismatch"
        ),
    )


def diurnal_profile(hourly: DataFrame) -> DataFrame:
    live = hourly.where(F.col("live_snapshot_count") > 0).select(
        "channel", F.hour("hour_bucket").alias("hour_of_day"), "avg_viewer_count"
    )
    own = live.groupBy("channel", "hour_of_day").agg(F.avg("avg_viewer_count").alias("streamer_avg_viewer_count"))
    event = live.groupBy("hour_of_day").agg(F.avg("avg_viewer_count").alias("event_avg_viewer_count"))
    return (
        own.join(event, own["hour_of_day"].eqNullSafe(event["hour_of_day"]) & own["hour_of_day"].isNotNull())
        .select(
            "channel", own["hour_of_day"], "streamer_avg_viewer_count", "event_avg_viewer_count",
            ratio("streamer_avg_viewer_count", "event_avg_viewer_count").alias("viewer_index_vs_event"),
        )
    )


def night_shift(moves: DataFrame) -> DataFrame:
    return (
        moves.groupBy(F.col("twitch_login").alias("channel"), F.hour("ingested_at").alias("hour_of_day"))
        .agg(
            F.sum("donation_delta_eur").alias("donation_delta_eur"),
            F.avg("viewer_count").alias("avg_viewer_count"),
        )
        .withColumn("donation_eur_per_viewer", ratio("donation_delta_eur", "avg_viewer_count"))
        .withColumn("is_overnight", F.col("hour_of_day").between(0, 5))
    )


def downtime_patterns(gaps: DataFrame) -> DataFrame:
    gap = "gap_before_next_session_seconds"
    return (
        gaps.where(F.col(gap).isNotNull())
        .groupBy("channel", "broadcaster_id")
        .agg(
            rows().alias("break_count"),
            F.avg(gap).alias("avg_gap_seconds"),
            F.max(gap).alias("longest_gap_seconds"),
            F.min(gap).alias("shortest_gap_seconds"),
        )
    )


def streamer_profile(
    snapshots: DataFrame,
    moves: DataFrame,
    metadata: DataFrame,
    broadcasts: DataFrame,
    chatter_channels: DataFrame,
    chatter_profiles: DataFrame,
    labels: list[str],
) -> DataFrame:
    identity = (
        snapshots.where(F.col("twitch_login").isNotNull())
        .groupBy(F.col("twitch_login").alias("channel"))
        .agg(F.max_by(F.struct("twitch_id", "display_name"), "snapshot_id").alias("_who"))
        .select("channel", "_who.*")
    )
    gained = F.when(F.col("donation_delta_eur") > 0, F.col("donation_delta_eur")).otherwise(F.lit(0))
    donations = moves.groupBy(F.col("twitch_login").alias("channel")).agg(
        F.max("donation_amount_eur").alias("latest_donation_amount_eur"),
        F.sum(gained).alias("donation_delta_sum_eur"),
    )
    # Totals and the four profile counts in one aggregate: a chatter has a profile exactly
    # when it has a channel row, so the inner join loses nothing.
    audience = (
        chatter_channels.join(chatter_profiles.select("chatter_id", "chatter_profile"), "chatter_id")
        .groupBy("channel")
        .agg(
            rows().alias("unique_chatter_count"),
            F.sum("message_count").alias("total_message_count"),
            *[
                F.nullif(F.count_if(F.col("chatter_profile") == label), F.lit(0)).alias(f"{label}_chatter_count")
                for label in labels
            ],
        )
    )
    viewership = broadcasts.groupBy("channel", "broadcaster_id").agg(
        rows().alias("session_count"),
        F.sum("duration_seconds").alias("total_stream_duration_seconds"),
        F.avg("avg_viewer_count").alias("avg_viewer_count"),
        F.max("peak_viewer_count").alias("peak_viewer_count"),
    )
    per_category = (
        metadata.where(F.col("category").isNotNull()).groupBy("channel", "category").agg(rows().alias("_polls"))
    )
    # Most polls wins; equal counts go to the alphabetically last name.
    categories = per_category.groupBy("channel").agg(
        F.max_by("category", F.struct("_polls", "category")).alias("top_category"),
        rows().alias("category_diversity_score"),
    )
    observed = metadata.agg(F.min("snapshot_at").alias("_from"), F.max("snapshot_at").alias("_to"))
    window = observed.select(seconds_between("_from", "_to")).scalar()
    joined = identity
    for part in (donations, audience, viewership, categories):
        joined = joined.join(part, "channel", "left")
    return joined.select(
        "channel", "twitch_id", "display_name", "latest_donation_amount_eur", "donation_delta_sum_eur",
        "unique_chatter_count", "total_message_count", *[f"{label}_chatter_count" for label in labels],
        "session_count", "total_stream_duration_seconds", "avg_viewer_count", "peak_viewer_count", "top_category",
        "category_diversity_score",
        ratio(F.col("total_stream_duration_seconds"), window).alias("uptime_pct"),
    )
