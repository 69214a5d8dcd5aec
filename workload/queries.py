"""Query name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamtally import Models
from streamtally.plans import chatters, layout
from streamtally.session import scratch_dir
from workload import ingest, tables

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Same values in types both engines hash alike: zone-less timestamps, doubles to six
    digits, maps as sorted text."""

    def plain(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            # The nudge keeps exact halves off the rounding border.
            c = F.round(c.cast("double") + F.lit(1e-8), 6)
        elif isinstance(field.dataType, T.MapType):
            pairs = F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"]))
            c = F.array_join(F.array_sort(pairs), ",")
        return c.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


MODELS = [
    "stg_chat", "stg_metadata", "stg_snapshots", "stg_goals", "stg_emotes",
    "chat_hourly_activity", "chatter_channel_activity", "chatter_activity", "chatter_quarter_hour",
    "chat_inter_arrival", "chat_channel_hops", "emote_usage", "emote_catalog_coverage", "chat_hourly_mood",
    "hourly_edges", "channel_pair_jaccard", "peer_chat", "donation_deltas", "donation_hourly_last", "donation_rank",
    "donation_rank_hourly", "stream_hourly_viewership", "stream_sessions", "session_gaps", "category_changes",
    "title_segments", "mode_changes", "stream_concurrency",
    "donation_timeseries", "donation_by_title", "donation_spikes", "donation_normalized", "donation_rank_churn",
    "donation_reconciliation", "goal_vs_reality", "goals_current", "goals_by_category", "event_phase_rows",
    "event_phase_totals",
    "engagement_vs_donations", "emote_trends", "emote_catalog_utilization", "new_chatters_per_channel",
    "badge_and_verbosity", "chat_spikes", "chatter_profile", "chatter_leaderboard", "account_age_profile",
    "chatter_retention", "retention_curve", "breadth_depth_lifespan", "bot_signal", "chatter_enriched",
    "streamer_profile", "diurnal_profile", "night_shift", "downtime_patterns", "viewership_timeseries",
    "category_timeline", "session_analysis", "category_cooccurrence", "concurrency_vs_performance",
    "liveness_reconciliation", "hourly_network", "channel_network", "chatter_migrations", "support_network",
    "event_daily_rollup", "mode_timeline",
]


def _measured(spark: SparkSession, sf_dir: str) -> Models:
    return tables.models(spark, sf_dir).measured(scratch_dir(spark, "key-stats"))


def _model(name: str) -> Query:
    return lambda spark, sf_dir: getattr(_measured(spark, sf_dir), name)


def _board(pick: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: pick(_measured(spark, sf_dir).chatter_leaderboard)


def _incremental_quarter_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs: up to a moment of the second day, some hours more, and the rest; each rewrites the days it touches."""
    m = tables.models(spark, sf_dir)
    table = chatters.quarter_hour_table(spark, scratch_dir(spark, "quarter-hours"))
    for until in ("2024-01-02 06:07:00", "2024-01-02 20:31:00", "2030-01-01 00:00:00"):
        chatters.store_quarter_hours(table, m.stg_chat.where(F.col("message_sent_at") < F.lit(until).cast("timestamp")), m.settings)
    return table.read()


def _laid_out_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = tables.models(spark, sf_dir)
    chat = m.stg_chat.select("channel", "message_sent_at")
    return layout.lay_out(chat, "channel", "message_sent_at", scratch_dir(spark, "chat-by-hour"), 16, m.settings)


def laid_out_hourly_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second and third day, read from their folders only."""
    return layout.hourly_messages(_laid_out_chat(spark, sf_dir), "2024-01-02", "2024-01-03")


def laid_out_session_talk(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = tables.models(spark, sf_dir)
    spans = m.stream_sessions.select("channel", "stream_started_at", "first_seen_at", "last_seen_at")
    placed = layout.lay_out_spans(spans, "channel", "first_seen_at", "last_seen_at", scratch_dir(spark, "sessions-by-hour"), 16, m.settings)
    return layout.session_talk(_laid_out_chat(spark, sf_dir), placed)


PLAIN: dict[str, Query] = {
    **{name: _model(name) for name in MODELS},
    "leaderboard_top_in_channel": _board(lambda b: chatters.top_in_channel(b, "ch3", 50)),
    "leaderboard_top_breadth": _board(lambda b: chatters.top_breadth(b, 50)),
    "leaderboard_top_event": _board(lambda b: chatters.top_event(b, 50)),
    "chatter_quarter_hour_incremental": _incremental_quarter_hours,
    "laid_out_hourly_messages": laid_out_hourly_messages,
    "laid_out_session_talk": laid_out_session_talk,
    **ingest.QUERIES,
}


def queries() -> dict[str, Query]:
    def finished(query: Query) -> Query:
        return lambda spark, sf_dir: comparable(query(spark, sf_dir))

    return {name: finished(query) for name, query in PLAIN.items()}
