"""The expected results as SQL for DuckDB, over the same driver tables.

Each query is a chain of named steps; `sql(name)` joins the steps a result needs into
one WITH statement. The formulations differ on purpose from the Spark side: ASOF
joins, self-joins, QUALIFY and plain windows instead of slices, sweeps and roll-ups.
"""

from __future__ import annotations

import re

from streamtally.functions import text
from workload import tables as t


def _stems(stems: list[str]) -> str:
    return f"regexp_matches(message_text, '(?i)\\b({'|'.join(stems)})')"


def duck_expr(text: str) -> str:
    return text.replace("$US", "epoch_us(ts)").replace("$TS", "make_timestamp").replace("$DIV", "//")


def _columns(columns: dict[str, str]) -> str:
    return ", ".join(f"{duck_expr(e)} as {name}" for name, e in columns.items())


def d(expr: str) -> str:
    """A double, rounded as the query results are; the nudge keeps exact halves off the border."""
    return f"round(cast({expr} as double) + 1e-8, 6)"


def secs(start: str, end: str) -> str:
    return f"((epoch_us({end}) - epoch_us({start})) / 1000000.0::double)"


_BADGES = (
    "case k % 6 when 0 then map {'subscriber': '12'} when 1 then map {'moderator': '1', 'subscriber': '3'} "
    "when 2 then map {'vip': '1'} when 3 then null else map {}::map(varchar, varchar) end"
)
_EMOTES = (
    "case k % 4 when 0 then map {'25': 2, '1902': 1} when 1 then map {}::map(varchar, int) when 2 then null "
    "else map {'354': 1} end"
)
_PROFILE = (
    "case when {n} = 1 then 'sedentaire' when {n} in (2, 3) then 'multi_streamer' "
    "when {n} between 4 and 10 then 'semi_nomade' else 'nomade' end"
)
_AGE = (
    "case when account_created_at >= timestamp '2024-02-01' - interval 30 day then 'new (<30d)' "
    "when account_created_at >= timestamp '2023-02-01' then '1mo-1yr' "
    "when account_created_at >= timestamp '2021-02-01' then '1-3yr' "
    "when account_created_at is not null then '3yr+' end"
)


def flat(column: str) -> str:
    """A map as sorted k=v text."""
    pairs = f"list_transform(map_entries({column}), lambda e: concat(e.key, '=', e.value))"
    return f"array_to_string(list_sort({pairs}), ',')"


STEPS: dict[str, str] = {
    "base0": f"select {_columns(t.BASE)} from events",
    "base": f"select *, {_columns(t.BASE_MORE)} from base0",
    "chat": (
        f"select {_columns({k: v for k, v in t.CHAT.items() if k not in ('user_type', 'broadcaster_type')})}, "
        f"nullif({t.CHAT['user_type']}, '') as user_type, nullif({t.CHAT['broadcaster_type']}, '') as broadcaster_type, "
        f"{_BADGES} as badges, {_EMOTES} as emotes from base"
    ),
    "meta": f"select {_columns(t.METADATA)} from base where {t.METADATA_FILTER}",
    "polls": f"select {_columns(t.SNAPSHOT)}, us, k from base where {t.SNAPSHOT_FILTER} and k not in (13, 14)",
    "spread": f"select *, unnest(range({t.CHANNELS})) as c from polls",
    "snaps": (
        "select id as snapshot_id, batch_id, row_number, website_mode, total_donation_amount_eur, total_viewer_count, "
        "ingested_at, twitch_id, lower(login) as twitch_login, display_name, profile_url, is_online, game, viewer_count, "
        "amount_cents from (select id, batch_id, row_number, website_mode, total_donation_amount_eur, "
        "total_viewer_count, ingested_at, "
        + _columns(
            {
                {"twitch_login": "login", "online": "is_online"}.get(k, k): v
                for k, v in t.STREAMER_FIELDS.items()
            }
        )
        + " from spread) x"
    ),
    "goals": f"select {_columns({k: v for k, v in t.GOALS.items() if k != 'twitch_login'})}, "
    f"lower({duck_expr(t.GOALS['twitch_login'])}) as twitch_login from part",
    "emo": f"select {_columns(t.EMOTES)} from part",
    # Chat steps
    "hourly": (
        "select channel, date_trunc('hour', message_sent_at) as hour_bucket, count(*) as message_count, "
        "count(distinct chatter_id) as unique_chatter_count from chat where message_sent_at is not null group by all"
    ),
    "tag_uses": (
        "select channel, date_trunc('hour', message_sent_at) as hour_bucket, 'twitch' as service, e.key as emote_id, "
        "e.value as n from chat, unnest(map_entries(emotes)) as u(e)"
    ),
    "word_uses": (
        "select w.channel, w.hour_bucket, emo.service, emo.emote_id, 1 as n from (select channel, "
        "date_trunc('hour', message_sent_at) as hour_bucket, unnest(string_split_regex(message_text, '\\s+')) as word "
        "from chat) w join emo on emo.emote_code = w.word and emo.channel in (w.channel, '__global__') "
        "and emo.service <> 'twitch'"
    ),
    "emote_use": (
        "select channel, hour_bucket, service, emote_id, cast(sum(n) as bigint) as usage_count "
        "from (select * from tag_uses union all select * from word_uses) group by all"
    ),
    "coverage": (
        "select a.channel, a.service, a.emote_id, cast(coalesce(sum(u.usage_count), 0) as bigint) as total_usage_count, "
        "count(u.usage_count) > 0 as was_used from (select channel, service, emote_id from emo where scope = 'channel' "
        "union select chat.channel, service, emote_id from emo, (select distinct channel from chat) chat "
        "where scope = 'global') a left join emote_use u using (channel, service, emote_id) group by all"
    ),
    # Chatter steps
    "known": "select * from chat where chatter_id is not null",
    "timed": "select * from known where message_sent_at is not null",
    "cc": (
        "select chatter_id, channel, count(*) as message_count, min(message_sent_at) as first_message_at, "
        "max(message_sent_at) as last_message_at, count(distinct date_trunc('hour', message_sent_at)) as active_hours "
        "from known group by all"
    ),
    "who": (
        "select chatter_id, chatter, account_created_at, broadcaster_type from known qualify row_number() over "
        "(partition by chatter_id order by message_sent_at desc nulls first, id desc) = 1"
    ),
    "ca": (
        "select k.chatter_id, any_value(who.chatter) as chatter, any_value(who.account_created_at) as account_created_at, "
        "any_value(who.broadcaster_type) as broadcaster_type, count(distinct channel) as channels, count(*) as messages, "
        "min(message_sent_at) as first_message_at, max(message_sent_at) as last_message_at, "
        "avg(length(message_text)) as avg_len from known k join who using (chatter_id) group by k.chatter_id"
    ),
    "ca2": f"select *, {secs('first_message_at', 'last_message_at')} as life from ca",
    "gaps": (
        "select chatter_id, channel, message_sent_at, lag(channel) over w as prev_channel, "
        "lag(message_sent_at) over w as prev_at from timed "
        "window w as (partition by chatter_id order by message_sent_at, id)"
    ),
    "hops": (
        f"select chatter_id, prev_channel as from_channel, channel as to_channel, prev_at as departed_at, "
        f"message_sent_at as arrived_at, {secs('prev_at', 'message_sent_at')} as gap_seconds from gaps "
        "where prev_channel <> channel and message_sent_at <= prev_at + interval 30 minute"
    ),
    "rhythm": (
        f"select chatter_id, count(*) as gap_count, avg(g) as avg_gap_seconds, stddev_samp(g) as stddev_gap_seconds from "
        f"(select chatter_id, {secs('prev_at', 'message_sent_at')} as g from gaps where prev_at is not null) x "
        "group by chatter_id having count(*) > 4"
    ),
    "qh": (
        "select chatter_id, time_bucket(interval 15 minute, message_sent_at) as quarter_hour_bucket, "
        "count(distinct channel) as distinct_channel_count, count(*) as message_count from timed group by all"
    ),
    "board": (
        "select cc.*, ca.chatter, ca.channels as distinct_channel_count, ca.messages as total_message_count, "
        "rank() over (partition by cc.channel order by cc.message_count desc) as rank_within_channel, "
        "rank() over (order by ca.messages desc) as rank_global from cc join ca using (chatter_id)"
    ),
    # Donation steps
    "moves": (
        "select *, amount_cents - lag(amount_cents) over w as moved, lag(ingested_at) over w as prev_ingested_at, "
        "coalesce(moved, 0) as delta_cents from snaps where twitch_login is not null "
        "window w as (partition by twitch_login order by ingested_at, snapshot_id)"
    ),
    "gains": "select * from moves where delta_cents > 0",
    "meta_last": (
        "select channel, snapshot_at, arg_max({'title': title, 'category': category, 'is_live': is_live}, id) as seen "
        "from meta group by channel, snapshot_at"
    ),
    "place": (
        "select *, rank() over (partition by ingested_at order by amount_cents desc nulls first) as donation_rank "
        "from snaps where twitch_login is not null"
    ),
    "places": (
        "select *, lag(donation_rank) over (partition by twitch_login order by ingested_at, snapshot_id) as prev_donation_rank, "
        "donation_rank - prev_donation_rank as rank_change from place"
    ),
    # Stream steps
    "vh": (
        "select channel, date_trunc('hour', snapshot_at) as hour_bucket, avg(viewer_count) as avg_viewers, "
        "max(viewer_count) as peak_viewers, count(*) filter (where is_live) as live_snapshot_count, "
        "count(*) as total_snapshot_count from meta group by all"
    ),
    "vlive": "select * from vh where live_snapshot_count > 0",
    "sess": (
        "select channel, broadcaster_id, stream_started_at, min(snapshot_at) as first_seen_at, "
        "max(snapshot_at) as last_seen_at, max(duration_seconds) as duration_seconds, avg(viewer_count) as avg_viewers, "
        "max(viewer_count) as peak_viewers from meta where is_live and stream_started_at is not null group by all"
    ),
    "breaks": (
        "select *, lead(stream_started_at) over (partition by channel order by stream_started_at, broadcaster_id) "
        "as next_at from sess"
    ),
    "air": (
        "select *, lag(title) over w as pt, lag(category) over w as pc, lag(viewer_count) over w as pv, "
        "title is distinct from pt or category is distinct from pc as changed from meta where is_live "
        "window w as (partition by channel order by snapshot_at, id)"
    ),
    "modes": (
        "select *, lag(website_mode) over (order by ingested_at, snapshot_id) as prev_mode from "
        "(select distinct snapshot_id, ingested_at, website_mode, total_donation_amount_eur, total_viewer_count from snaps)"
    ),
    "mode_moves": "select * from modes where website_mode is distinct from prev_mode",
    # Community steps
    "edges": (
        "select chatter_id, channel, date_trunc('hour', message_sent_at) as hour_bucket, count(*) as message_count "
        "from known group by all"
    ),
    "fans": "select channel, count(*) as n from cc group by channel",
    "overlap": (
        "select x.channel as channel_a, y.channel as channel_b, count(*) as shared_chatter_count from cc x join cc y "
        "on x.chatter_id = y.chatter_id and x.channel < y.channel group by all"
    ),
    "jaccard": (
        "select o.*, a.n as channel_a_chatter_count, b.n as channel_b_chatter_count, "
        f"{d('o.shared_chatter_count / (a.n + b.n - o.shared_chatter_count)::double')} as jaccard_index "
        "from overlap o join fans a on a.channel = channel_a join fans b on b.channel = channel_b"
    ),
    "peers": (
        "select chatter_id, lower(chatter) as supporting_streamer_login, channel as supported_channel, message_sent_at "
        "from known where lower(chatter) in (select twitch_login from snaps where twitch_login is not null) "
        "and lower(chatter) <> channel"
    ),
    # Event steps
    "progress": (
        f"select twitch_login, ingested_at, delta_cents, {secs('min(ingested_at) over ()', 'ingested_at')} / "
        f"nullif({secs('min(ingested_at) over ()', 'max(ingested_at) over ()')}, 0) as p from moves"
    ),
    "phases": (
        "select *, case when p < 0.2 then 'opening' when p < 0.8 then 'middle' else 'final_push' end as event_phase "
        "from progress"
    ),
}

_SESSION = "channel, stream_started_at"


def eur(column: str) -> str:
    return d(f"{column} / 100.0::double")


RESULTS: dict[str, str] = {
    "stg_chat": (
        "select id, batch_id, row_number, channel, chatter, chatter_id, message_text, message_sent_at, captured_at, "
        f"{flat('badges')} as badges, {flat('emotes')} as emotes, account_created_at, ingested_at, user_type, "
        "broadcaster_type from chat"
    ),
    "stg_metadata": f"select * replace ({d('duration_seconds')} as duration_seconds) from meta",
    "stg_snapshots": (
        f"select * exclude (amount_cents) replace ({d('total_donation_amount_eur')} as total_donation_amount_eur), "
        f"{eur('amount_cents')} as donation_amount_eur from snaps"
    ),
    "stg_goals": f"select * replace ({d('goal_amount_eur')} as goal_amount_eur) from goals",
    "stg_emotes": "select * from emo",
    "chat_hourly_activity": "select * from hourly",
    "chat_hourly_mood": (
        "select channel, date_trunc('hour', message_sent_at) as hour_bucket, count(*) as message_count, "
        + ", ".join(
            f"{d(f'count(*) filter (where {cond}) / count(*)::double')} as {name}"
            for name, cond in {
                "punct_rate": "position('!!' in message_text) > 0",
                "caps_rate": "length(message_text) > 3 and message_text = upper(message_text) and message_text <> lower(message_text)",
                "emote_rate": _stems(text.HYPE_STEMS),
                "positive_rate": _stems(text.POSITIVE_STEMS),
                "hostile_rate": _stems(text.HOSTILE_STEMS),
            }.items()
        )
        + " from chat where message_sent_at is not null group by all having count(*) > 19"
    ),
    "chat_spikes": (
        f"select channel, hour_bucket, message_count, unique_chatter_count, {d('m')} as channel_avg_message_count, "
        f"{d('s')} as channel_stddev_message_count, {d('(message_count - m) / s')} as message_count_zscore from "
        "(select *, avg(message_count) over (partition by channel) as m, "
        "stddev_samp(message_count) over (partition by channel) as s from hourly) where s > 0 and message_count >= m + 2 * s"
    ),
    "emote_usage": "select * from emote_use",
    "emote_catalog_coverage": "select * from coverage",
    "emote_trends": (
        "select *, rank() over (partition by channel, day_bucket order by usage_count desc nulls first) as rank_within_channel_day "
        "from (select channel, service, emote_id, cast(date_trunc('day', hour_bucket) as timestamp) as day_bucket, "
        "cast(sum(usage_count) as bigint) as usage_count from emote_use group by all)"
    ),
    "emote_catalog_utilization": (
        "select channel, service, count(*) as catalog_size, count(*) filter (where was_used) as used_count, "
        f"cast(sum(total_usage_count) as bigint) as total_usage_count, {d('avg(was_used::int)')} as utilization_pct "
        "from coverage group by all"
    ),
    "engagement_vs_donations": (
        f"select h.channel, h.hour_bucket, message_count, unique_chatter_count, {eur('cents')} as donation_delta_eur, "
        f"{d('v')} as avg_viewer_count, {d('case when v > 0 then message_count / 60.0::double / (v / 100.0::double) end')} "
        "as msgs_per_min_per_100_viewers from hourly h left join (select twitch_login as channel, "
        "date_trunc('hour', ingested_at) as hour_bucket, sum(delta_cents) as cents, avg(viewer_count) as v from moves "
        "group by all) g using (channel, hour_bucket)"
    ),
    "new_chatters_per_channel": (
        "select channel, cast(date_trunc('day', first_message_at) as timestamp) as day_bucket, "
        "count(*) as new_chatters_to_channel from cc group by all"
    ),
    "badge_and_verbosity": (
        "select channel, count(*) as message_count, "
        "count(*) filter (where map_contains(badges, 'subscriber')) as subscriber_message_count, "
        "count(*) filter (where map_contains(badges, 'vip')) as vip_message_count, "
        "count(*) filter (where map_contains(badges, 'moderator')) as moderator_message_count, "
        "count(*) filter (where coalesce(cardinality(badges), 0) = 0) as plain_viewer_message_count, "
        f"{d('avg(length(message_text))')} as avg_message_length, "
        f"{d("avg(length(message_text)) filter (where map_contains(badges, 'subscriber'))")} as avg_message_length_subscriber, "
        f"{d("avg(length(message_text)) filter (where coalesce(cardinality(badges), 0) = 0)")} as avg_message_length_plain_viewer "
        "from chat group by channel"
    ),
    "chatter_channel_activity": "select * from cc",
    "chatter_activity": (
        "select chatter_id, chatter, account_created_at, broadcaster_type, channels as distinct_channel_count, "
        f"messages as total_message_count, first_message_at, last_message_at, {d('avg_len')} as avg_message_length, "
        f"{d('life')} as lifespan_seconds, regexp_matches(chatter, '[0-9][0-9][0-9][0-9]$') as has_long_digit_suffix from ca2"
    ),
    "chatter_profile": (
        "select chatter_id, chatter, channels as distinct_channel_count, messages as total_message_count, "
        f"m as max_channel_message_count, {d('m / messages::double')} as top_channel_share, "
        f"{_PROFILE.format(n='channels')} as chatter_profile from ca join (select chatter_id, max(message_count) as m "
        "from cc group by chatter_id) using (chatter_id)"
    ),
    "account_age_profile": (
        f"select chatter_id, chatter, account_created_at, {_PROFILE.format(n='channels')} as chatter_profile, "
        f"channels as distinct_channel_count, {_AGE} as account_age_bucket from ca"
    ),
    "breadth_depth_lifespan": (
        "select chatter_id, chatter, channels as distinct_channel_count, messages as total_message_count, "
        f"first_message_at, last_message_at, {d('life')} as lifespan_seconds, "
        "round(messages::decimal(18,4) / channels, 1)::double as avg_messages_per_channel, "
        "round(life / 3600, 1) as lifespan_hours from ca2"
    ),
    "chat_inter_arrival": (
        f"select chatter_id, channel, message_sent_at, {d(secs('prev_at', 'message_sent_at'))} as inter_arrival_seconds from gaps"
    ),
    "chat_channel_hops": f"select * replace ({d('gap_seconds')} as gap_seconds) from hops",
    "bot_signal": (
        "select chatter_id, chatter, account_created_at, regexp_matches(chatter, '[0-9][0-9][0-9][0-9]$') as "
        f"has_long_digit_suffix, messages as total_message_count, gap_count, {d('avg_gap_seconds')} as avg_gap_seconds, "
        f"{d('stddev_gap_seconds')} as stddev_gap_seconds, "
        f"{d('stddev_gap_seconds / nullif(avg_gap_seconds, 0)')} as gap_coefficient_of_variation "
        "from ca left join rhythm using (chatter_id)"
    ),
    "chatter_enriched": (
        "select ca2.chatter_id, chatter, channels as distinct_channel_count, messages as total_message_count, "
        f"m as max_channel_message_count, {d('m / messages::double')} as top_channel_share, "
        f"{_PROFILE.format(n='channels')} as chatter_profile, account_created_at, {_AGE} as account_age_bucket, "
        "regexp_matches(chatter, '[0-9][0-9][0-9][0-9]$') as has_long_digit_suffix, gap_count, "
        f"{d('avg_gap_seconds')} as avg_gap_seconds, {d('stddev_gap_seconds')} as stddev_gap_seconds, "
        f"{d('stddev_gap_seconds / nullif(avg_gap_seconds, 0)')} as gap_coefficient_of_variation, first_message_at, "
        f"last_message_at, {d('life')} as lifespan_seconds, "
        "round(messages::decimal(18,4) / channels, 1)::double as avg_messages_per_channel, "
        "round(life / 3600, 1) as lifespan_hours from ca2 left join rhythm using (chatter_id) "
        "left join (select chatter_id, max(message_count) as m from cc group by chatter_id) using (chatter_id)"
    ),
    "chatter_leaderboard": (
        "select chatter_id, chatter, channel, message_count, active_hours, first_message_at, last_message_at, "
        "distinct_channel_count, total_message_count, rank_within_channel, rank_global from board"
    ),
    "leaderboard_top_in_channel": (
        "select chatter_id, chatter, channel, message_count, active_hours, first_message_at, last_message_at, "
        "distinct_channel_count, total_message_count, rank_within_channel, rank_global from board "
        "where channel = 'ch3' order by rank_within_channel, chatter_id limit 50"
    ),
    "leaderboard_top_breadth": (
        "select distinct chatter_id, chatter, distinct_channel_count, total_message_count, rank_global from board "
        "order by distinct_channel_count desc, total_message_count desc, chatter_id limit 50"
    ),
    "leaderboard_top_event": (
        "select distinct chatter_id, chatter, distinct_channel_count, total_message_count, rank_global from board "
        "order by rank_global, chatter_id limit 50"
    ),
    "chatter_quarter_hour": "select * from qh",
    "chatter_quarter_hour_incremental": "select * from qh",
    "chatter_retention": (
        "select q.chatter_id, who.chatter, quarter_hour_bucket, distinct_channel_count, message_count, "
        "first_value(quarter_hour_bucket) over w as first_active_quarter_hour, "
        "row_number() over w = 1 as is_new_this_quarter_hour, "
        "count(*) over (partition by q.chatter_id) as total_quarter_hours_active from qh q left join who using (chatter_id) "
        "window w as (partition by q.chatter_id order by quarter_hour_bucket)"
    ),
    "retention_curve": (
        "select n as day_index, active as active_chatter_count, max(active) filter (where n = 0) over () as cohort_size, "
        f"{d('active / (max(active) filter (where n = 0) over ())::double')} as retention_pct from (select "
        "date_diff('day', first_day, quarter_hour_bucket) as n, count(distinct q.chatter_id) as active from qh q join "
        "(select chatter_id, min(date_trunc('day', quarter_hour_bucket)) as first_day from qh group by chatter_id) f "
        "using (chatter_id) group by n)"
    ),
    "hourly_edges": "select * from edges",
    "hourly_network": (
        "select hour_bucket, x.channel as channel_a, y.channel as channel_b, count(*) as shared_chatter_count, "
        "cast(sum(least(x.message_count, y.message_count)) as bigint) as min_message_overlap from edges x join edges y "
        "using (chatter_id, hour_bucket) where x.channel < y.channel group by all"
    ),
    "channel_pair_jaccard": "select * from jaccard",
    "channel_network": "select * from jaccard where shared_chatter_count > 2",
    "chatter_migrations": (
        "select from_channel, to_channel, count(*) as hop_count, count(distinct chatter_id) as distinct_chatters_hopping, "
        f"{d('avg(gap_seconds)')} as avg_gap_seconds from hops group by all"
    ),
    "peer_chat": "select * from peers",
    "support_network": (
        "select supporting_streamer_login, supported_channel, count(*) as message_count, "
        "min(message_sent_at) as first_message_at, max(message_sent_at) as last_message_at from peers group by all"
    ),
    "donation_deltas": (
        f"select snapshot_id, twitch_login, display_name, game, is_online, viewer_count, {eur('amount_cents')} as "
        f"donation_amount_eur, {d('total_donation_amount_eur')} as total_donation_amount_eur, total_viewer_count, "
        f"ingested_at, prev_ingested_at, {eur('delta_cents')} as donation_delta_eur, "
        f"{d(secs('prev_ingested_at', 'ingested_at'))} as seconds_since_prev_snapshot from moves"
    ),
    "donation_timeseries": (
        f"select twitch_login, display_name, game, is_online, viewer_count, {eur('amount_cents')} as donation_amount_eur, "
        f"{eur('delta_cents')} as donation_delta_eur, {d('total_donation_amount_eur')} as total_donation_amount_eur, "
        f"total_viewer_count, ingested_at, {d('s')} as seconds_since_prev_snapshot, "
        "cast(date_trunc('day', ingested_at) as timestamp) as day_bucket, "
        f"{d('delta_cents / 100.0::double / (nullif(s, 0) / 60.0::double)')} as donation_velocity_eur_per_min "
        f"from (select *, {secs('prev_ingested_at', 'ingested_at')} as s from moves)"
    ),
    "donation_hourly_last": (
        f"select twitch_login, display_name, date_trunc('hour', ingested_at) as hour_bucket, {eur('amount_cents')} as "
        "donation_amount_eur from moves qualify row_number() over (partition by twitch_login, "
        "date_trunc('hour', ingested_at) order by ingested_at desc, snapshot_id desc) = 1"
    ),
    "donation_rank": (
        f"select snapshot_id, twitch_login, display_name, ingested_at, {eur('amount_cents')} as donation_amount_eur, "
        "donation_rank, prev_donation_rank, rank_change from places"
    ),
    "donation_rank_hourly": (
        "select twitch_login, display_name, date_trunc('hour', ingested_at) as hour_bucket, donation_rank, "
        "prev_donation_rank, rank_change from places qualify row_number() over (partition by twitch_login, "
        "date_trunc('hour', ingested_at) order by ingested_at desc, snapshot_id desc) = 1"
    ),
    "donation_rank_churn": (
        "select twitch_login, display_name, ingested_at, donation_rank, prev_donation_rank, rank_change, "
        "donation_rank < 11 as in_top_10 from places"
    ),
    "donation_by_title": (
        f"select g.twitch_login, display_name, g.ingested_at, {eur('delta_cents')} as donation_delta_eur, "
        "case when snapshot_at >= g.ingested_at - interval 5 minute then seen.title end as title, "
        "case when snapshot_at >= g.ingested_at - interval 5 minute then seen.category end as category "
        "from gains g asof left join meta_last m on g.twitch_login = m.channel and g.ingested_at >= m.snapshot_at"
    ),
    "donation_spikes": (
        f"select g.twitch_login, display_name, g.ingested_at, {eur('delta_cents')} as donation_delta_eur, "
        "case when snapshot_at >= g.ingested_at - interval 5 minute then seen.title end as title, "
        "case when snapshot_at >= g.ingested_at - interval 5 minute then seen.category end as category, "
        "h.message_count as chat_messages_that_hour from gains g asof left join meta_last m "
        "on g.twitch_login = m.channel and g.ingested_at >= m.snapshot_at left join hourly h on h.channel = g.twitch_login "
        "and h.hour_bucket = date_trunc('hour', g.ingested_at) "
        "order by delta_cents desc, g.ingested_at, g.twitch_login, g.snapshot_id limit 200"
    ),
    "donation_normalized": (
        f"select twitch_login, {eur('top')} as latest_donation_amount_eur, {d('v')} as avg_viewer_count, "
        f"fans.n as unique_chatter_count, {d('top / 100.0::double / nullif(v, 0)')} as donation_eur_per_avg_viewer, "
        f"{d('top / 100.0::double / fans.n')} as donation_eur_per_unique_chatter from (select twitch_login, "
        "max(amount_cents) as top, avg(viewer_count) as v from moves group by twitch_login) "
        "left join fans on fans.channel = twitch_login"
    ),
    "donation_reconciliation": (
        f"select snapshot_id, ingested_at, {d('max(total_donation_amount_eur)')} as total_donation_amount_eur, "
        f"{eur('sum(amount_cents)')} as sum_of_streamer_donations_eur, "
        f"{d('max(total_donation_amount_eur) - sum(amount_cents) / 100.0::double')} as divergence_eur "
        "from snaps group by all"
    ),
    "goals_current": (
        f"select participation_id, streamer_name, twitch_login, twitch_id, goal_id, goal_name, {d('goal_amount_eur')} as "
        "goal_amount_eur, goal_category, snapshot_at, count(*) over o as goal_count_for_streamer, "
        f"{d('sum(goal_amount_eur) over o')} as total_goal_amount_eur_for_streamer from goals "
        "window o as (partition by twitch_login)"
    ),
    "goals_by_category": (
        "select goal_category, count(*) as goal_count, count(distinct twitch_login) as streamer_count, "
        f"{d('sum(goal_amount_eur)')} as total_goal_amount_eur, {d('avg(goal_amount_eur::double)')} as avg_goal_amount_eur "
        "from goals group by goal_category"
    ),
    "goal_vs_reality": (
        f"select twitch_login, {d('wanted')} as total_goal_amount_eur_for_streamer, {eur('top')} as "
        f"latest_donation_amount_eur, {d('top / 100.0::double - wanted::double')} as surplus_eur, "
        f"{d('top / 100.0::double / nullif(wanted::double, 0)')} as pct_of_goals_covered from (select twitch_login, "
        "sum(goal_amount_eur) as wanted from goals group by twitch_login) join (select twitch_login, "
        "max(amount_cents) as top from moves group by twitch_login) using (twitch_login)"
    ),
    "stream_hourly_viewership": (
        f"select channel, hour_bucket, {d('avg_viewers')} as avg_viewer_count, peak_viewers as peak_viewer_count, "
        "live_snapshot_count, total_snapshot_count from vh"
    ),
    "viewership_timeseries": (
        f"select channel, hour_bucket, {d('avg_viewers')} as avg_viewer_count, peak_viewers as peak_viewer_count, "
        "live_snapshot_count, total_snapshot_count, "
        "rank() over (partition by hour_bucket order by avg_viewers desc nulls first) as viewer_rank_at_hour from vlive"
    ),
    "stream_concurrency": (
        "select hour_bucket, count(*) filter (where live_snapshot_count > 0) as live_channel_count, "
        f"{d('sum(avg_viewers) filter (where live_snapshot_count > 0)')} as total_avg_viewer_count from vh group by hour_bucket"
    ),
    "concurrency_vs_performance": (
        f"select channel, hour_bucket, {d('avg_viewers')} as avg_viewer_count, "
        f"count(*) over o as live_channel_count, {d('sum(avg_viewers) over o')} as total_avg_viewer_count from vlive "
        "window o as (partition by hour_bucket)"
    ),
    "stream_sessions": (
        f"select channel, broadcaster_id, stream_started_at, first_seen_at, last_seen_at, {d('duration_seconds')} as "
        f"duration_seconds, {d('avg_viewers')} as avg_viewer_count, peak_viewers as peak_viewer_count from sess"
    ),
    "session_gaps": (
        "select channel, broadcaster_id, stream_started_at, last_seen_at, next_at as next_session_started_at, "
        f"{d(secs('last_seen_at', 'next_at'))} as gap_before_next_session_seconds from breaks"
    ),
    "category_changes": (
        "select channel, broadcaster_id, snapshot_at as changed_at, pc as prev_category, category as new_category, "
        "pt as prev_title, title as new_title, pv as prev_viewer_count, viewer_count as viewer_count_at_change "
        "from air where changed"
    ),
    "title_segments": (
        "select channel, broadcaster_id, segment_id, title, category, min(snapshot_at) as segment_started_at, "
        f"max(snapshot_at) as segment_ended_at, count(*) as snapshot_count, {d('avg(viewer_count)')} as avg_viewer_count, "
        "max(viewer_count) as max_viewer_count from (select *, cast(sum(changed::int) over (partition by channel "
        "order by snapshot_at, id rows unbounded preceding) as bigint) as segment_id from air) group by all"
    ),
    "mode_changes": (
        "select snapshot_id, ingested_at as changed_at, prev_mode as prev_website_mode, website_mode as new_website_mode, "
        f"{d('total_donation_amount_eur')} as total_donation_amount_eur, total_viewer_count from mode_moves"
    ),
    "category_timeline": (
        "select air.channel, broadcaster_id, snapshot_at as changed_at, pc as prev_category, category as new_category, "
        "pt as prev_title, title as new_title, viewer_count as viewer_count_at_change, "
        f"{d('vh.avg_viewers')} as avg_viewer_count_hour_after from air left join vh on vh.channel = air.channel "
        "and vh.hour_bucket = date_trunc('hour', snapshot_at + interval 1 hour) where changed"
    ),
    "category_cooccurrence": (
        "select category, date_trunc('hour', snapshot_at) as hour_bucket, count(distinct channel) as channel_count_playing "
        "from meta where is_live and category is not null group by all"
    ),
    "session_analysis": (
        f"select s.channel, s.broadcaster_id, s.stream_started_at, {d('s.duration_seconds')} as duration_seconds, "
        f"{d('s.avg_viewers')} as avg_viewer_count, s.peak_viewers as peak_viewer_count, v0 as viewer_count_at_start, "
        f"v1 as viewer_count_at_end, h1 as message_count_first_half, h2 as message_count_second_half, "
        f"{eur('cents')} as donation_delta_during_session, "
        "case when s.duration_seconds >= 43200 then 13 else cast(floor(s.duration_seconds / 3600) as int) + 1 end "
        "as duration_bucket_index, v1 - v0 as viewer_change from sess s "
        f"left join (select {_SESSION}, first(viewer_count order by snapshot_at, id) as v0, "
        "last(viewer_count order by snapshot_at, id) as v1 from meta where is_live group by all) "
        f"using ({_SESSION}) left join (select s.channel, s.stream_started_at, "
        "count(*) filter (where epoch_us(message_sent_at) < (epoch_us(first_seen_at) + epoch_us(last_seen_at)) / 2) as h1, "
        "count(*) filter (where epoch_us(message_sent_at) >= (epoch_us(first_seen_at) + epoch_us(last_seen_at)) / 2) as h2 "
        "from sess s join chat on chat.channel = s.channel and message_sent_at between first_seen_at and last_seen_at "
        f"group by all) using ({_SESSION}) left join (select s.channel, s.stream_started_at, sum(delta_cents) as cents "
        "from sess s join moves on twitch_login = s.channel and ingested_at between first_seen_at and last_seen_at "
        f"group by all) using ({_SESSION})"
    ),
    "liveness_reconciliation": (
        "select twitch_login, snapshot_id, ingested_at as event_snapshot_at, is_online as event_reported_online, "
        "case when near then seen.is_live end as helix_reported_live, case when near then snapshot_at end as helix_snapshot_at, "
        "coalesce(near and is_online is distinct from seen.is_live, false) as liveness_mismatch from (select z.*, m.seen, "
        "m.snapshot_at, m.snapshot_at >= z.ingested_at - interval 5 minute as near from snaps z asof left join meta_last m "
        "on z.twitch_login = m.channel and z.ingested_at >= m.snapshot_at)"
    ),
    "diurnal_profile": (
        f"select channel, h as hour_of_day, {d('a')} as streamer_avg_viewer_count, {d('e')} as event_avg_viewer_count, "
        f"{d('a / nullif(e, 0)')} as viewer_index_vs_event from (select channel, cast(hour(hour_bucket) as int) as h, "
        "avg(avg_viewers) as a from vlive group by all) join (select cast(hour(hour_bucket) as int) as h, "
        "avg(avg_viewers) as e from vlive group by all) using (h)"
    ),
    "night_shift": (
        f"select channel, hour_of_day, {eur('cents')} as donation_delta_eur, {d('v')} as avg_viewer_count, "
        f"{d('cents / 100.0::double / nullif(v, 0)')} as donation_eur_per_viewer, hour_of_day < 6 as is_overnight from "
        "(select twitch_login as channel, cast(hour(ingested_at) as int) as hour_of_day, sum(delta_cents) as cents, "
        "avg(viewer_count) as v from moves group by all)"
    ),
    "downtime_patterns": (
        f"select channel, broadcaster_id, count(*) as break_count, {d('avg(g)')} as avg_gap_seconds, "
        f"{d('max(g)')} as longest_gap_seconds, {d('min(g)')} as shortest_gap_seconds from "
        f"(select *, {secs('last_seen_at', 'next_at')} as g from breaks) where g is not null group by all"
    ),
    "streamer_profile": (
        f"select i.channel, i.twitch_id, i.display_name, {eur('top')} as latest_donation_amount_eur, "
        f"{eur('up')} as donation_delta_sum_eur, f.n as unique_chatter_count, f.messages as total_message_count, "
        "p1 as sedentaire_chatter_count, p2 as multi_streamer_chatter_count, p3 as semi_nomade_chatter_count, "
        f"p4 as nomade_chatter_count, session_count, {d('streamed')} as total_stream_duration_seconds, "
        f"{d('v')} as avg_viewer_count, peak as peak_viewer_count, top_category, category_diversity_score, "
        f"{d('streamed / nullif(w.s, 0)')} as uptime_pct from "
        "(select twitch_login as channel, arg_max(twitch_id, snapshot_id) as twitch_id, "
        "arg_max(display_name, snapshot_id) as display_name from snaps where twitch_login is not null group by all) i "
        "left join (select twitch_login as channel, max(amount_cents) as top, sum(greatest(delta_cents, 0)) as up "
        "from moves group by all) using (channel) "
        "left join (select cc.channel, count(*) as n, cast(sum(message_count) as bigint) as messages, "
        "nullif(count(*) filter (where channels = 1), 0) as p1, "
        "nullif(count(*) filter (where channels in (2, 3)), 0) as p2, "
        "nullif(count(*) filter (where channels between 4 and 10), 0) as p3, "
        "nullif(count(*) filter (where channels > 10), 0) as p4 from cc join ca using (chatter_id) group by all) f "
        "using (channel) left join (select channel, broadcaster_id, count(*) as session_count, "
        "sum(duration_seconds) as streamed, avg(avg_viewers) as v, max(peak_viewers) as peak from sess group by all) "
        "using (channel) left join (select channel, arg_max(category, (n, category)) as top_category, "
        "count(*) as category_diversity_score from (select channel, category, count(*) as n from meta "
        "where category is not null group by all) group by channel) using (channel), "
        f"(select {secs('min(snapshot_at)', 'max(snapshot_at)')} as s from meta) w"
    ),
    "event_phase_rows": (
        f"select twitch_login, ingested_at, {eur('delta_cents')} as donation_delta_eur, {d('p')} as event_progress_pct, "
        "event_phase from phases"
    ),
    "event_phase_totals": (
        f"select event_phase, count(distinct twitch_login) as streamer_count, {eur('sum(delta_cents)')} as "
        f"total_donation_delta_eur, {d('sum(delta_cents) / (select sum(delta_cents) from phases)::double')} as "
        "pct_of_event_total from phases group by event_phase"
    ),
    "event_daily_rollup": (
        "select cast(day_bucket as timestamp) as day_bucket, message_count, active_channels, "
        f"{eur('cents')} as donation_delta_eur, {d('total')} as total_donation_amount_eur_end_of_day, "
        f"{d('v')} as avg_total_viewer_count from (select date_trunc('day', hour_bucket) as day_bucket, "
        "cast(sum(message_count) as bigint) as message_count, count(distinct channel) as active_channels from hourly "
        "group by all) full join (select date_trunc('day', ingested_at) as day_bucket, sum(delta_cents) as cents, "
        "max(total_donation_amount_eur) as total, avg(total_viewer_count) as v from moves group by all) using (day_bucket)"
    ),
    "mode_timeline": (
        "select website_mode, ingested_at as segment_started_at, lead(ingested_at) over w as segment_ended_at, "
        f"{d('total_donation_amount_eur')} as donation_amount_eur_at_start, total_viewer_count as viewer_count_at_start, "
        f"{d('lead(total_donation_amount_eur) over w - total_donation_amount_eur')} as donation_delta_during_segment "
        "from mode_moves window w as (order by ingested_at, snapshot_id)"
    ),
}


def needed(text: str, steps: dict[str, str]) -> list[str]:
    """Names of the steps `text` refers to, directly or through other steps, in order."""
    found: set[str] = set()
    pending = [text]
    while pending:
        words = set(re.findall(r"[a-z_0-9]+", pending.pop()))
        for name in words & steps.keys() - found:
            found.add(name)
            pending.append(steps[name])
    return [name for name in steps if name in found]


def statement(text: str, steps: dict[str, str]) -> str:
    chain = ", ".join(f"{name} as ({steps[name]})" for name in needed(text, steps))
    return f"with {chain} {text}" if chain else text


def oracle_sql() -> dict[str, str]:
    from workload import ingest_oracle

    steps = {**STEPS, **ingest_oracle.STEPS}
    return {name: statement(text, steps) for name, text in {**RESULTS, **ingest_oracle.RESULTS}.items()}
