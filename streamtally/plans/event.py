"""Event-wide views: phases, days, site modes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamtally.functions.ratio import ratio, rows
from streamtally.functions.time import day_of, seconds_between
from streamtally.operators.ordered import next_row
from streamtally.settings import Settings


def phase_rows(moves: DataFrame, snapshots: DataFrame, settings: Settings) -> DataFrame:
    """Each donation move with its place in the observed span. A span of zero length
    has no progress, and without progress a row counts as the final push. The span is read
    off the named snapshots, which the moves have one row for each."""
    named = snapshots.where(F.col("twitch_login").isNotNull())
    bounds = named.agg(F.min("ingested_at").alias("_from"), F.max("ingested_at").alias("_to"))
    start, end = bounds.select("_from").scalar(), bounds.select("_to").scalar()
    progress = ratio(seconds_between(start, "ingested_at"), seconds_between(start, end))
    return moves.select(
        "twitch_login", "ingested_at", "donation_delta_eur", progress.alias("event_progress_pct")
    ).withColumn(
        "event_phase",
        F.when(F.col("event_progress_pct") < settings.opening_until, "opening")
        .when(F.col("event_progress_pct") < settings.middle_until, "middle")
        .otherwise("final_push"),
    )


def phase_totals(rows: DataFrame) -> DataFrame:
    # At most three rows meet in the event-wide window.
    everything = Window.partitionBy()
    return (
        rows.groupBy("event_phase")
        .agg(
            F.countDistinct("twitch_login").alias("streamer_count"),
            F.sum("donation_delta_eur").alias("total_donation_delta_eur"),
        )
        .withColumn(
            "pct_of_event_total",
            ratio(F.col("total_donation_delta_eur"), F.sum("total_donation_delta_eur").over(everything)),
        )
    )


def daily_rollup(chat_hourly: DataFrame, moves: DataFrame) -> DataFrame:
    chat = chat_hourly.groupBy(day_of("hour_bucket").alias("day_bucket")).agg(
        F.sum("message_count").alias("message_count"), F.countDistinct("channel").alias("active_channels")
    )
    donations = moves.groupBy(day_of("ingested_at").alias("day_bucket")).agg(
        F.sum("donation_delta_eur").alias("donation_delta_eur"),
        F.max("total_donation_amount_eur").alias("total_donation_amount_eur_end_of_day"),
        F.avg("total_viewer_count").alias("avg_total_viewer_count"),
    )
    return chat.join(donations, "day_bucket", "full_outer")


def mode_timeline(changes: DataFrame) -> DataFrame:
    """`changes` still have the slices of the polls, so they are not cut again."""
    ordered = next_row(changes, [], ["changed_at", "snapshot_id"], ["changed_at", "total_donation_amount_eur"])
    return ordered.select(
        F.col("new_website_mode").alias("website_mode"),
        F.col("changed_at").alias("segment_started_at"),
        F.col("next.changed_at").alias("segment_ended_at"),
        F.col("total_donation_amount_eur").alias("donation_amount_eur_at_start"),
        F.col("total_viewer_count").alias("viewer_count_at_start"),
        (F.col("next.total_donation_amount_eur") - F.col("total_donation_amount_eur")).alias(
            "donation_delta_during_segment"
        ),
    )
