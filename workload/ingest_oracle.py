"""SQL for the queries of `workload.ingest`; steps are shared with `workload.oracle`."""

from __future__ import annotations

from streamtally.plans.quality import RULES
from workload import tables as t
from workload.oracle import RESULTS as MODEL_RESULTS
from workload.oracle import d, duck_expr, eur, flat, secs

_BADGE_TEXT = f"({t.BADGES_TAG})"
_EMOTE_TEXT = f"({t.EMOTES_TAG})"


def _tag_list(entries: dict[str, str]) -> str:
    return "[" + ", ".join(f"'{name}=' || {value}" for name, value in entries.items()) + "]"


_TAGS = _tag_list(
    {
        "tmi-sent-ts": "cast(us // 1000 as varchar)",
        "badges": _BADGE_TEXT,
        "emotes": _EMOTE_TEXT,
        "user-id": f"({t.CHAT['chatter_id']})",
        "user-type": f"({t.CHAT['user_type']})",
        "display-name": f"(case when k % 5 = 0 then '' else {t.CHAT['chatter']} end)",
    }
)

STEPS = {
    # Chat lines that are messages
    "lines": (
        "select event_id as id, make_timestamp(us + 1000000) as captured_at, us, k, user_id, "
        f"'nick' || event_id as nick, channel, coalesce({t.CHAT['message_text']}, '') || case when k % 17 = 3 then chr(8232) || 'tail' || chr(13) || 'x' || chr(133) || 'y' else '' end as txt, k % 9 <> 0 as tagged, "
        f"{t.CHAT['chatter']} as display, {t.CHAT['chatter_id']} as uid, {t.CHAT['user_type']} as utype, "
        f"array_to_string(list_sort(list_filter({_TAGS}, lambda x: x is not null)), ',') as tagtext, "
        f"{_BADGE_TEXT} as btag, {_EMOTE_TEXT} as etag from base"
    ),
    "typedlines": (
        "select id, upper(channel) as channel, case when tagged and k % 5 <> 0 then display else nick end as chatter, "
        "case when tagged then uid end as chatter_id, txt as message_text, "
        "case when tagged then make_timestamp(us // 1000 * 1000) else captured_at end as message_sent_at, captured_at, "
        "case when not tagged then '' else array_to_string(list_sort(list_transform(list_filter("
        "string_split(coalesce(btag, ''), ','), lambda x: x <> ''), lambda x: replace(x, '/', '='))), ',') end as badges, "
        "case when tagged then utype end as user_type, "
        "case when not tagged or etag is null or etag = '' then '' when etag like '25%' then '1902=1,25=2' else '354=1' "
        "end as emotes from lines where cast(substring(channel, 3) as int) % 2 = 0"
    ),
    "facts": (
        "select chatter_id, max(account_created_at) as account_created_at, max(bt) as broadcaster_type, "
        "min(captured_at) + interval 1 hour as resolved_at from (select *, "
        f"{t.CHAT['broadcaster_type']} as bt from base join (select id, captured_at, chatter_id, account_created_at "
        "from chat) on id = event_id) where chatter_id is not null and cast(chatter_id as bigint) % 3 <> 0 group by chatter_id"
    ),
    "pages": (
        f"select {', '.join(f'{duck_expr(e)} as {n}' for n, e in t.EMOTES.items())}, p_partkey // 100 as page, p_partkey from part"
    ),
    "whole": (
        "select *, max(fetched_at) over (partition by service, scope, channel, page) as page_at from pages"
    ),
    "watch": (
        "select event_id as poll_id, make_timestamp(us) as snapshot_at, 'ch' || c as channel, 'bch' || c as broadcaster_id, "
        "(k + c) % 5 <> 0 as is_live, case when is_live then (k * 7 + c * 13) % 500 end as viewer_count, "
        "case when is_live then {'title': case when (k + c) % 7 <> 0 then 'title' || (k % 3) end, "
        "'category': 'game' || ((k + c) % 4), 'at': make_timestamp(us // 14400000000 * 14400000000)} end as air "
        f"from base, unnest(range({t.CHANNELS})) as u(c) where {t.SNAPSHOT_FILTER}"
    ),
    "watched": (
        "select * exclude (air), last_value(air ignore nulls) over (partition by channel order by snapshot_at, poll_id "
        f"rows unbounded preceding) as air, {secs('air.at', 'snapshot_at')} as age from watch"
    ),
    "parts": f"select *, least((us - {t.T0}) // 27000000000, 7) as part from base",
    "turns": "select unnest(range(8)) as turn",
    "latest_emotes": (
        "select * from emo qualify row_number() over (partition by service, scope, channel, emote_id "
        "order by fetched_at desc) = 1"
    ),
}

_MOVES = (
    f"select snapshot_id, twitch_login, display_name, viewer_count, {eur('amount_cents')} as donation_amount_eur, "
    f"ingested_at, prev_ingested_at, {eur('delta_cents')} as donation_delta_eur, "
    f"{d(secs('prev_ingested_at', 'ingested_at'))} as seconds_since_prev_snapshot from moves"
)

RESULTS = {
    "parse_chat_lines": (
        "select id, captured_at, nick, channel, txt as text, case when tagged then tagtext end as tags from lines"
    ),
    "parse_badges": f"select id, coalesce({flat('badges')}, '') as badges from chat",
    "parse_emotes": f"select id, coalesce({flat('emotes')}, '') as emotes from chat",
    "build_chat_rows": "select * from typedlines",
    "enrich_accounts": (
        "select id, l.chatter_id, case when resolved_at <= captured_at then account_created_at end as account_created_at, "
        "case when resolved_at <= captured_at then broadcaster_type end as broadcaster_type from typedlines l "
        "left join facts using (chatter_id)"
    ),
    "pending_accounts": (
        "select distinct chatter_id from typedlines where chatter_id is not null "
        "and chatter_id not in (select chatter_id from facts)"
    ),
    "parse_event_snapshot": (
        f"select * exclude (amount_cents) replace ({d('total_donation_amount_eur')} as total_donation_amount_eur), "
        f"{eur('amount_cents')} as donation_amount_eur from snaps"
    ),
    "latest_event": (
        "select cast(o_orderkey as varchar) as id, 'Marathon ' || o_orderpriority as name, "
        "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as start from orders where o_orderstatus = 'F' "
        "order by o_orderdate desc, cast(o_orderkey as varchar) desc limit 1"
    ),
    "build_goal_rows": (
        "select 'p' || s_suppkey as participation_id, s_name as streamer_name, "
        "case when s_suppkey % 5 <> 0 then lower(s_name) end as twitch_login, "
        "case when s_suppkey % 5 <> 0 then 't' || s_suppkey end as twitch_id, cast(p_partkey as varchar) as goal_id, "
        f"p_name as goal_name, {d('round(p_retailprice * 100) / 100')} as goal_amount_eur, p_brand as goal_category, "
        "timestamp '2024-01-01' as snapshot_at from supplier join part on s_suppkey = p_partkey % 100 where s_suppkey % 4 > 0"
    ),
    "parse_emote_catalogs": (
        "select service, scope, channel, emote_id, emote_code, page_at as fetched_at from whole"
    ),
    "flatten_emote_sets": "select channel, emote_id, emote_code from whole where service = 'ffz'",
    "merge_channel_emote_lists": (
        "select service, channel, emote_id, emote_code from whole where scope = 'channel' and service in ('7tv', 'bttv')"
    ),
    "emote_catalog_counts": "select service, count(*) as emote_count from emo group by service",
    "build_metadata_snapshots": (
        "select poll_id, channel, broadcaster_id, is_live, air.title as title, air.category as category, viewer_count, "
        f"round(case when is_live then age end + 1e-8, 6) as duration_seconds, air.at as stream_started_at, snapshot_at "
        "from watched"
    ),
    "poll_summary": (
        "select snapshot_at, count(*) filter (where is_live) as live_count, count(*) as channel_count, "
        "cast(coalesce(sum(viewer_count), 0) as bigint) as total_viewers from watch group by snapshot_at"
    ),
    "stream_end_events": (
        "select channel, snapshot_at as stream_ended_at from meta qualify not is_live and "
        "lag(is_live) over (partition by channel order by snapshot_at, id)"
    ),
    "roster_additions": (
        "select twitch_login as channel, min(ingested_at) as first_seen_at from snaps where twitch_login not in "
        "('ch0', 'ch2', 'ch4', 'ch6') group by twitch_login"
    ),
    "recover_replay_chat": (
        "select 'recovered/ch' || (conv_id % 12) || '/' || conv_id || '-' || (turn // 100) as batch_id, "
        "cast(row_number() over (partition by conv_id, turn // 100 order by turn) - 1 as int) as row_number, 'ch' || (conv_id % 12) as channel, role as chatter, 'id_' || role as chatter_id, "
        f"text as message_text, make_timestamp({t.T0} + (conv_id * 100 + turn) * 1000000) as message_sent_at, "
        f"make_timestamp({t.T0} + (conv_id * 100 + turn) * 1000000) as captured_at, 'vip=' || turn as badges, "
        "coalesce(array_to_string(list_sort(list_transform(map_entries(list_histogram(list_transform(list_filter("
        "string_split(text, ' '), lambda w: length(w) = 5), lambda w: lower(w)))), "
        "lambda e: concat(e.key, '=', e.value))), ','), '') as emotes, "
        f"make_timestamp({t.T0} - conv_id * 1000000) as account_created_at from conversations"
    ),
    "explode_envelope": (
        "select 'live_chat' as stream, batch_id, row_number, true as readable, row_number as own_number, channel from chat"
    ),
    "typed_chat_rows": (
        "select batch_id, row_number, channel, chatter, chatter_id, message_text, message_sent_at, captured_at, "
        f"{flat('badges')} as badges, {t.CHAT['user_type'].replace('k %', 'b.k %')} as user_type, account_created_at, "
        f"{t.CHAT['broadcaster_type'].replace('user_id', 'b.user_id')} as broadcaster_type, {flat('emotes')} as emotes "
        "from (select * exclude (user_type, broadcaster_type) from chat) join (select event_id, k, user_id from base) b "
        "on b.event_id = id"
    ),
    "route_by_stream": (
        "select * from (values ('live_chat', 'insert', (select count(*) from events)), "
        "('emote_catalog', 'upsert', (select count(*) from part)), "
        "('weather', 'quarantine', (select count(*) from part))) v(stream, route, row_count)"
    ),
    "quarantine": (
        "select * from (select 'live_chat' as stream, case when epoch_us(captured_at) // 1000000 % 2 = 0 then 'malformed row' "
        "when row_number % 10 = 7 then 'required field missing' end as reason, count(*) as row_count from chat group by all) "
        "where reason is not null union all select 'weather', 'unknown stream', count(*) from part union all "
        "select null, 'unreadable envelope', count(distinct p_partkey // 1000) from part"
    ),
    "append_dedup": "select batch_id, row_number, channel, message_text from chat where row_number % 2 = 1",
    "staging_merge": "select count(*) as rows_merged from chat where row_number % 2 = 1",
    "upsert_latest": "select * from latest_emotes",
    "write_rolling_parquet": "select id, channel, message_text from chat",
    "scan_bronze": (
        f"select id, channel, {flat('badges')} as badges, case when id % 2 = 1 then {flat('emotes')} end as emotes from chat"
    ),
    "dq_unique": (
        "select chatter_id, count(*) as row_count from chat where chatter_id is not null group by chatter_id having count(*) > 1"
    ),
    "dq_unique_combination": (
        "select chatter_id, channel, user_type, count(*) as row_count from chat group by all having count(*) > 1"
    ),
    "dq_not_null": "select id, channel from chat where chatter_id is null",
    "dq_accepted_values": (
        "select case when channels < 4 then 'multi_streamer' else 'semi_nomade' end as chatter_profile, "
        "count(*) as row_count from ca where channels between 2 and 10 group by 1"
    ),
    "dq_between": (
        f"select twitch_login, ingested_at, snapshot_id, {eur('delta_cents')} as donation_delta_eur, 'warn' as severity "
        "from moves where delta_cents < 0"
    ),
    "dq_exclude_synthetic": "select id, channel from chat where channel not in ('ch1', 'ch10', 'ch11')",
    "source_freshness": (
        f"select newest, {d('a')} as age_minutes, case when a > 60 then 'error' when a > 15 then 'warn' else 'pass' end "
        f"as status from (select max(ingested_at) as newest, "
        f"{secs('max(ingested_at)', chr(39) + '2024-01-03 12:20:00' + chr(39) + '::timestamp')} / 60 as a from chat)"
    ),
    "gap_detection": (
        f"select channel, message_sent_at as gap_started_at, next_at as gap_ended_at, {d(secs('message_sent_at', 'next_at'))} "
        "as gap_seconds from (select *, lead(message_sent_at) over (partition by channel order by message_sent_at, id) "
        "as next_at from chat where message_sent_at is not null) where next_at > message_sent_at + interval 900 second"
    ),
    "gap_detection_overall": (
        f"select message_sent_at as gap_started_at, next_at as gap_ended_at, {d(secs('message_sent_at', 'next_at'))} "
        "as gap_seconds from (select *, lead(message_sent_at) over (order by message_sent_at, id) "
        "as next_at from chat where message_sent_at is not null) where next_at > message_sent_at + interval 60 second"
    ),
    "stream_dedup": "select batch_id, row_number, channel, captured_at from chat",
    "stream_hourly_chat": (
        "select * from hourly"
    ),
    "stream_quarter_hour": (
        "select * from qh"
    ),
    "chat_running_counts": "select channel, chatter, count(*) as message_count from chat group by all",
    "channel_running_counts": "select channel, count(*) as message_count from chat group by all",
    "stream_late_rows": (
        "select channel, date_trunc('hour', message_sent_at) as hour_bucket, count(*) as message_count, "
        "count(distinct chatter_id) as unique_chatter_count from chat join base on event_id = id where message_sent_at is not null "
        f"and not (us - {t.T0} < 54000000000 and k % 10 = 0) group by all".replace("channel, date", "chat.channel, date")
    ),
    "stream_stall_alert": (
        "select channel, make_timestamp(seen + 1000000) as last_seen_at, make_timestamp(now) as noticed_at, "
        f"{d('(now - seen - 1000000) / 60e6')} as silent_minutes from (select turn, channel, max(us) as seen from turns "
        "join (select us, channel, part from parts) on part <= turn group by all) join (select turn, max(us) as now from turns "
        f"join (select us, part from parts where {t.SNAPSHOT_FILTER}) on part <= turn group by all) using (turn) "
        "where now - seen - 1000000 > 300000000 qualify row_number() over (partition by channel, seen order by turn) = 1"
    ),
    "laid_out_hourly_messages": "select channel, hour_bucket, message_count from hourly where hour_bucket >= timestamp '2024-01-02' and hour_bucket < timestamp '2024-01-04'",
    "stream_rolling_parquet": (
        "select channel, count(*) as row_count, count(distinct id) as id_count, true as files_within_limit from chat group by channel"
    ),
    "ingested_chat": (
        "select batch_id, row_number, channel, chatter, chatter_id, message_text, message_sent_at, captured_at, "
        f"{flat('badges')} as badges, {t.CHAT['user_type'].replace('k %', 'b.k %')} as user_type, account_created_at, "
        f"{t.CHAT['broadcaster_type'].replace('user_id', 'b.user_id')} as broadcaster_type, {flat('emotes')} as emotes, "
        "max(captured_at) over (partition by batch_id) as ingested_at "
        "from (select * exclude (user_type, broadcaster_type) from chat) join (select event_id, k, user_id from base) b "
        "on b.event_id = id"
    ),
    "stream_donation_deltas": _MOVES,
    "stream_mode_changes": (
        "select snapshot_id, ingested_at as changed_at, prev_mode as prev_website_mode, website_mode as new_website_mode, "
        f"{d('total_donation_amount_eur')} as total_donation_amount_eur, total_viewer_count from mode_moves"
    ),
    "stream_channel_hops": f"select * replace ({d('gap_seconds')} as gap_seconds) from hops",
    "stream_ingest": (
        "select 'live_chat' as \"table\", batch_id || '/' || row_number as identity, channel from chat union all "
        "select 'emote_catalog', concat_ws('/', service, scope, emote_id, emote_code), channel from latest_emotes"
    ),
}
RESULTS["ingested_streamer_profile"] = MODEL_RESULTS["streamer_profile"]
RESULTS["laid_out_session_talk"] = (
    "select channel, stream_started_at, message_count_first_half, message_count_second_half from "
    f"({MODEL_RESULTS['session_analysis']}) where message_count_first_half + message_count_second_half > 0"
)
RESULTS["recover_replay_files"] = RESULTS["recover_replay_chat"]
RESULTS["dq_freshness"] = RESULTS["source_freshness"]


_STAGED = {"stg_chat": "select * from chat", "stg_metadata": "select * from meta", "stg_goals": "select * from goals", "stg_emotes": "select * from emo"}
STEPS |= {f"ruled_{model}": _STAGED.get(model) or MODEL_RESULTS[model] for model in dict.fromkeys(r.model for r in RULES)}


def _violations(rule) -> str:
    source, column = f"ruled_{rule.model}", rule.columns[0]
    if rule.check == "unique":
        listed = ", ".join(rule.columns)
        known = f"where {column} is not null " if len(rule.columns) == 1 else ""
        found = f"select count(*) from (select {listed} from {source} {known}group by {listed} having count(*) > 1)"
    elif rule.check == "not_null":
        found = f"select count(*) from {source} where {column} is null"
    elif rule.check == "between":
        low, high = rule.bounds
        outside = [f"{column} < {low}"] * (low is not None) + [f"{column} > {high}"] * (high is not None)
        found = f"select count(*) from {source} where {' or '.join(outside)}"
    else:
        accepted = ", ".join(f"'{v}'" for v in rule.values)
        found = f"select count(distinct {column}) from {source} where {column} not in ({accepted})"
    return f"select '{rule.model}' as model, '{rule.check}' as \"check\", '{','.join(rule.columns)}' as columns, '{rule.severity}' as severity, ({found}) as violations"


RESULTS["quality_report"] = " union all ".join(map(_violations, RULES))
