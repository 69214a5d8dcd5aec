"""All models over one set of bronze tables, composed lazily."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import cached_property

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from streamtally.functions.time import day_of
from streamtally.operators.key_stats import KeyStats
from streamtally.plans import chat, chatters, community, donations, event, staging, streams
from streamtally.schemas import PROFILES
from streamtally.settings import Settings


class Models:
    """`Models(bronze).chatter_enriched` is a DataFrame; nothing runs until it is used.

    `bronze` maps table names of `schemas.BRONZE` to DataFrames; a model needs only the
    tables it reads. A model shared by many others can be written once with
    `materialize` and is then read back instead of recomputed.
    """

    def __init__(self, bronze: dict[str, DataFrame], settings: Settings = Settings()):
        self.bronze = bronze
        self.settings = settings

    def materialize(self, names: Iterable[str], root: str, at_once: int = 1) -> "Models":
        """Writes the named models as Parquet under `root` and reads them from there on. Models that do not read each
        other may be written several at once, so that the last tasks of one do not leave the cluster idle."""
        def write(name: str, df: DataFrame) -> None:
            path = f"{root.rstrip('/')}/{name}"
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
            self.__dict__[name] = df.sparkSession.read.schema(df.schema).parquet(path)

        if at_once == 1:
            for name in names:
                write(name, getattr(self, name))
            return self
        with ThreadPoolExecutor(at_once) as pool:
            # Composing stays in one thread: it may run the small jobs of key statistics.
            frames = [(name, getattr(self, name)) for name in names]
            running = [pool.submit(inheritable_thread_target(df.sparkSession)(write), name, df) for name, df in frames]
        for done in running:
            done.result()
        return self

    def measured(self, root: str) -> "Models":
        """The same models with the key statistics of their sequences kept under `root`: each sequence is measured
        by one small job when a model that needs it is first composed, and not again by every plan."""
        return Models(self.bronze, replace(self.settings, key_stats=KeyStats(root)))

    # Staging
    @cached_property
    def stg_chat(self):
        return staging.chat(self.bronze["live_chat"])

    @cached_property
    def stg_metadata(self):
        return staging.metadata(self.bronze["metadata_snapshots"])

    @cached_property
    def stg_snapshots(self):
        return staging.snapshots(self.bronze["event_snapshots"])

    @cached_property
    def stg_goals(self):
        return staging.goals(self.bronze["donation_goals"])

    @cached_property
    def stg_emotes(self):
        return staging.emotes(self.bronze["emote_catalog"])

    # Chat
    @cached_property
    def chat_hourly_activity(self):
        return chat.hourly_activity(self.stg_chat)

    @cached_property
    def chat_hourly_mood(self):
        return chat.hourly_mood(self.stg_chat, self.settings)

    @cached_property
    def chat_spikes(self):
        return chat.spikes(self.chat_hourly_activity, self.settings)

    @cached_property
    def emote_usage(self):
        return chat.emote_usage(self.stg_chat, self.stg_emotes)

    @cached_property
    def emote_daily_usage(self):
        return chat.emote_usage(self.stg_chat, self.stg_emotes, day_of, "day_bucket")

    @cached_property
    def emote_channel_usage(self):
        return chat.emote_usage(self.stg_chat, self.stg_emotes, None)

    @cached_property
    def emote_catalog_coverage(self):
        return chat.emote_catalog_coverage(self.stg_chat, self.stg_emotes, self.emote_channel_usage)

    @cached_property
    def emote_trends(self):
        return chat.emote_trends(self.emote_daily_usage, self.settings)

    @cached_property
    def emote_catalog_utilization(self):
        return chat.emote_catalog_utilization(self.emote_catalog_coverage)

    @cached_property
    def engagement_vs_donations(self):
        return chat.engagement_vs_donations(self.chat_hourly_activity, self.donation_deltas)

    @cached_property
    def new_chatters_per_channel(self):
        return chat.new_chatters_per_channel(self.chatter_channel_activity)

    @cached_property
    def badge_and_verbosity(self):
        return chat.badge_and_verbosity(self.stg_chat)

    # Chatters
    @cached_property
    def chatter_channel_activity(self):
        return chatters.channel_activity(self.stg_chat)

    @cached_property
    def chatter_rollup(self):
        return chatters.rollup(self.stg_chat)

    @cached_property
    def chatter_activity(self):
        return chatters.activity(self.chatter_rollup)

    @cached_property
    def chatter_profile(self):
        return chatters.profile(self.chatter_rollup, self.settings)

    @cached_property
    def account_age_profile(self):
        return chatters.account_age_profile(self.chatter_rollup, self.settings)

    @cached_property
    def breadth_depth_lifespan(self):
        return chatters.breadth_depth_lifespan(self.chatter_rollup)

    @cached_property
    def chatter_timeline(self):
        return chatters.timeline(self.stg_chat, self.settings)

    @cached_property
    def chat_inter_arrival(self):
        return chatters.inter_arrival(self.chatter_timeline)

    @cached_property
    def chat_channel_hops(self):
        return chatters.channel_hops(self.chatter_timeline, self.settings)

    @cached_property
    def chatter_regularity(self):
        return chatters.regularity(self.chat_inter_arrival, self.settings)

    @cached_property
    def bot_signal(self):
        return chatters.bot_signal(self.chatter_rollup, self.chatter_regularity)

    @cached_property
    def chatter_enriched(self):
        return chatters.enriched(self.chatter_rollup, self.chatter_regularity, self.settings)

    @cached_property
    def chatter_leaderboard(self):
        return chatters.leaderboard(self.chatter_channel_activity, self.chatter_rollup, self.settings)

    @cached_property
    def chatter_quarter_hour(self):
        return chatters.quarter_hours(self.stg_chat)

    @cached_property
    def chatter_retention(self):
        return chatters.retention(self.chatter_quarter_hour, self.chatter_rollup)

    @cached_property
    def retention_curve(self):
        return chatters.retention_curve(self.chatter_quarter_hour)

    # Community
    @cached_property
    def hourly_edges(self):
        return community.hourly_edges(self.stg_chat)

    @cached_property
    def hourly_network(self):
        return community.hourly_network(self.hourly_edges, self.settings)

    @cached_property
    def channel_pair_jaccard(self):
        return community.channel_pair_jaccard(self.stg_chat, self.settings)

    @cached_property
    def channel_network(self):
        return community.channel_network(self.channel_pair_jaccard, self.settings)

    @cached_property
    def chatter_migrations(self):
        return community.chatter_migrations(self.chat_channel_hops)

    @cached_property
    def peer_chat(self):
        return community.peer_chat(self.stg_chat, self.stg_snapshots)

    @cached_property
    def support_network(self):
        return community.support_network(self.peer_chat)

    # Donations
    @cached_property
    def donation_deltas(self):
        return donations.deltas(self.stg_snapshots, self.settings)

    @cached_property
    def donation_timeseries(self):
        return donations.timeseries(self.donation_deltas)

    @cached_property
    def donation_hourly_last(self):
        return donations.hourly_last(self.donation_deltas)

    @cached_property
    def donation_rank(self):
        return donations.rank(self.stg_snapshots, self.settings)

    @cached_property
    def donation_rank_hourly(self):
        return donations.rank_hourly(self.donation_rank)

    @cached_property
    def donation_rank_churn(self):
        return donations.rank_churn(self.donation_rank, self.settings)

    @cached_property
    def donation_by_title(self):
        return donations.by_title(self.donation_deltas, self.stg_metadata, self.settings)

    @cached_property
    def donation_spikes(self):
        return donations.spike_moments(
            self.donation_deltas, self.stg_metadata, self.chat_hourly_activity, self.settings
        )

    @cached_property
    def donation_normalized(self):
        return donations.normalized(self.donation_deltas, self.chatter_channel_activity)

    @cached_property
    def donation_reconciliation(self):
        return donations.reconciliation(self.stg_snapshots)

    @cached_property
    def goals_current(self):
        return donations.goals_current(self.stg_goals)

    @cached_property
    def goals_by_category(self):
        return donations.goals_by_category(self.stg_goals)

    @cached_property
    def goal_vs_reality(self):
        return donations.goal_vs_reality(self.stg_goals, self.donation_deltas)

    # Streams
    @cached_property
    def stream_hourly_viewership(self):
        return streams.hourly_viewership(self.stg_metadata)

    @cached_property
    def viewership_timeseries(self):
        return streams.viewership_timeseries(self.stream_hourly_viewership)

    @cached_property
    def stream_concurrency(self):
        return streams.concurrency(self.stream_hourly_viewership)

    @cached_property
    def concurrency_vs_performance(self):
        return streams.concurrency_vs_performance(self.stream_hourly_viewership, self.stream_concurrency)

    @cached_property
    def stream_sessions(self):
        return streams.sessions(self.stg_metadata)

    @cached_property
    def session_gaps(self):
        return streams.session_gaps(self.stream_sessions, self.settings)

    @cached_property
    def category_changes(self):
        return streams.category_changes(self.stg_metadata, self.settings)

    @cached_property
    def title_segments(self):
        return streams.title_segments(self.stg_metadata, self.settings)

    @cached_property
    def sliced_mode_changes(self):
        return streams.sliced_mode_changes(self.stg_snapshots, self.settings)

    @cached_property
    def mode_changes(self):
        return streams.mode_changes(self.stg_snapshots, self.settings)

    @cached_property
    def category_timeline(self):
        return streams.category_timeline(self.category_changes, self.stream_hourly_viewership)

    @cached_property
    def category_cooccurrence(self):
        return streams.category_cooccurrence(self.stg_metadata)

    @cached_property
    def session_analysis(self):
        return streams.session_analysis(
            self.stg_metadata, self.stream_sessions, self.stg_chat, self.donation_deltas, self.settings
        )

    @cached_property
    def liveness_reconciliation(self):
        return streams.liveness_reconciliation(self.stg_snapshots, self.stg_metadata, self.settings)

    @cached_property
    def diurnal_profile(self):
        return streams.diurnal_profile(self.stream_hourly_viewership)

    @cached_property
    def night_shift(self):
        return streams.night_shift(self.donation_deltas)

    @cached_property
    def downtime_patterns(self):
        return streams.downtime_patterns(self.session_gaps)

    @cached_property
    def streamer_profile(self):
        return streams.streamer_profile(
            self.stg_snapshots, self.donation_deltas, self.stg_metadata, self.stream_sessions,
            self.chatter_channel_activity, self.chatter_profile, PROFILES,
        )

    # Event
    @cached_property
    def event_phase_rows(self):
        return event.phase_rows(self.donation_deltas, self.stg_snapshots, self.settings)

    @cached_property
    def event_phase_totals(self):
        return event.phase_totals(self.event_phase_rows)

    @cached_property
    def event_daily_rollup(self):
        return event.daily_rollup(self.chat_hourly_activity, self.donation_deltas)

    @cached_property
    def mode_timeline(self):
        return event.mode_timeline(self.sliced_mode_changes)
