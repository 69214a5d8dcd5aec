"""Bronze table schemas. JSON columns arrive as text and are typed once, on read."""

from __future__ import annotations

MONEY = "decimal(18,2)"

LIVE_CHAT = (
    "id bigint, batch_id string, row_number int, channel string, chatter string, chatter_id string, "
    "message_text string, message_sent_at timestamp, captured_at timestamp, ingested_at timestamp, "
    "badges map<string,string>, user_type string, account_created_at timestamp, broadcaster_type string, "
    "emotes map<string,int>"
)
METADATA_SNAPSHOTS = (
    "id bigint, batch_id string, row_number int, channel string, broadcaster_id string, is_live boolean, "
    "title string, category string, viewer_count int, duration_seconds double, stream_started_at timestamp, "
    "snapshot_at timestamp, ingested_at timestamp"
)
STREAMER = (
    f"struct<twitch_id: string, twitch_login: string, display_name: string, profile_url: string, "
    f"online: boolean, game: string, viewer_count: int, donation_amount_eur: {MONEY}>"
)
EVENT_SNAPSHOTS = (
    "id bigint, batch_id string, row_number int, website_mode string, total_donation_amount_eur double, "
    f"total_viewer_count int, streamers array<{STREAMER}>, ingested_at timestamp"
)
DONATION_GOALS = (
    "participation_id string, streamer_name string, twitch_login string, twitch_id string, goal_id string, "
    "goal_name string, goal_amount_eur decimal(12,2), goal_category string, snapshot_at timestamp, "
    "ingested_at timestamp"
)
EMOTE_CATALOG = (
    "service string, scope string, channel string, emote_id string, emote_code string, fetched_at timestamp, "
    "ingested_at timestamp"
)

BRONZE = {
    "live_chat": LIVE_CHAT,
    "metadata_snapshots": METADATA_SNAPSHOTS,
    "event_snapshots": EVENT_SNAPSHOTS,
    "donation_goals": DONATION_GOALS,
    "emote_catalog": EMOTE_CATALOG,
}

# Identity of a row: replays of an event-log row are dropped, a later row of a
# latest-state table replaces the earlier one.
EVENT_LOG_KEY = ["batch_id", "row_number"]
LATEST_STATE_KEYS = {
    "donation_goals": ["participation_id", "goal_id"],
    "emote_catalog": ["service", "scope", "channel", "emote_id"],
}
LATEST_STATE_CLOCK = {"donation_goals": "snapshot_at", "emote_catalog": "fetched_at"}
# Event time of each table, by which its parts are skipped.
CLOCKS = {
    "live_chat": "message_sent_at", "metadata_snapshots": "snapshot_at", "event_snapshots": "ingested_at",
    "donation_goals": "snapshot_at", "emote_catalog": "fetched_at",
}

# Fixed values of the catalog.
GLOBAL_CHANNEL = "__global__"
SERVICES = ["twitch", "7tv", "bttv", "ffz"]
SCOPES = ["global", "channel"]
PROFILES = ["sedentaire", "multi_streamer", "semi_nomade", "nomade"]
