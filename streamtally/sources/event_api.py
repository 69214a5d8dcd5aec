"""Event and donation-goal API documents to bronze rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamtally.schemas import MONEY

_NUMBER = "struct<number: double>"
RAW_SNAPSHOT = (
    f"websiteMode string, donationAmount {_NUMBER}, viewersCount {_NUMBER}, "
    "live array<struct<twitch_id: string, twitch: string, display: string, profileUrl: string, online: boolean, "
    f"game: string, viewersAmount: {_NUMBER}, donationAmount: struct<number: {MONEY}>>>"
)


def parse_event_snapshot(raw: DataFrame, body: str = "body") -> DataFrame:
    """The event document as a typed snapshot with its array of streamers; other columns are
    kept. A document that is not valid JSON gives nulls and no streamers."""
    kept = [c for c in raw.columns if c != body]

    def streamer(s: Column) -> Column:
        return F.struct(
            s["twitch_id"].alias("twitch_id"),
            s["twitch"].alias("twitch_login"),
            s["display"].alias("display_name"),
            s["profileUrl"].alias("profile_url"),
            s["online"].alias("online"),
            s["game"].alias("game"),
            s["viewersAmount"]["number"].cast("int").alias("viewer_count"),
            s["donationAmount"]["number"].alias("donation_amount_eur"),
        )

    return raw.withColumn("_d", F.from_json(body, RAW_SNAPSHOT)).select(
        *kept,
        F.col("_d.websiteMode").alias("website_mode"),
        F.col("_d.donationAmount.number").alias("total_donation_amount_eur"),
        F.col("_d.viewersCount.number").cast("int").alias("total_viewer_count"),
        F.transform("_d.live", streamer).alias("streamers"),
    )


def latest_event(events: DataFrame, name_prefix: str) -> DataFrame:
    """Of the events whose name starts with `name_prefix` the one that starts last; an error
    if there is none. `events`: id, name, schedule struct<start, end>."""
    latest = F.max_by(F.struct("id", "name", "schedule"), F.struct("schedule.start", "id"))
    missing = F.raise_error(F.lit(f"no event named '{name_prefix} *'")).cast("boolean")
    return (
        events.where(F.col("name").startswith(name_prefix))
        .agg(latest.alias("_event"))
        .where(F.when(F.col("_event").isNull(), missing).otherwise(F.lit(True)))
        .select("_event.*")
    )


def build_goal_rows(participations: DataFrame, goals: DataFrame, snapshot_at: Column) -> DataFrame:
    """Goals of the participations that have any, in euros. `participations`: id, name,
    donation_goals_count, socials struct<twitch struct<id, login>>; `goals`: participation_id,
    id, name, amount in cents, category."""
    with_goals = participations.where(F.col("donation_goals_count") > 0).select(
        F.col("id").alias("participation_id"),
        F.col("name").alias("streamer_name"),
        F.col("socials.twitch.login").alias("twitch_login"),
        F.col("socials.twitch.id").alias("twitch_id"),
    )
    wanted = goals.select(
        "participation_id",
        F.col("id").alias("goal_id"),
        F.col("name").alias("goal_name"),
        (F.col("amount") / F.lit(100)).cast("decimal(12,2)").alias("goal_amount_eur"),
        F.col("category").alias("goal_category"),
    )
    return with_goals.join(wanted, "participation_id").withColumn("snapshot_at", snapshot_at)
