"""Hand-computed results at the edges of the models."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from streamtally import Models, Settings
from streamtally.plans import chat, chatters, donations, event, staging, streams
from streamtally.schemas import BRONZE

S = Settings()
T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def at(seconds=0.0, micros=0):
    return T0 + dt.timedelta(seconds=seconds, microseconds=micros)


def table(spark, name, rows):
    """Bronze rows given as dicts; missing columns are null."""
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(BRONZE[name])
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def messages(spark, rows):
    return staging.chat(table(spark, "live_chat", [{"id": i, "channel": "a", **r} for i, r in enumerate(rows)]))


def metadata(spark, rows):
    base = {"channel": "a", "is_live": True, "snapshot_at": T0}
    return staging.metadata(table(spark, "metadata_snapshots", [{"id": i, **base, **r} for i, r in enumerate(rows)]))


SNAP = (
    "snapshot_id bigint, twitch_login string, display_name string, game string, is_online boolean, viewer_count int, "
    "donation_amount_eur decimal(18,2), total_donation_amount_eur double, total_viewer_count int, ingested_at timestamp, "
    "website_mode string, twitch_id string"
)


def snapshots(spark, rows):
    names = ["snapshot_id", "twitch_login", "display_name", "game", "is_online", "viewer_count", "donation_amount_eur",
             "total_donation_amount_eur", "total_viewer_count", "ingested_at", "website_mode", "twitch_id"]
    from decimal import Decimal

    def cell(r, n):
        v = r.get(n)
        return Decimal(str(v)) if n == "donation_amount_eur" and v is not None else v

    return spark.createDataFrame([tuple(cell({"snapshot_id": i, **r}, n) for n in names) for i, r in enumerate(rows)], SNAP)


def test_asof_edges(spark):
    moves = donations.deltas(
        snapshots(spark, [{"twitch_login": c, "ingested_at": at(t), "donation_amount_eur": a}
                          for c in "abcd" for t, a in ((-600, 0), (0, 5))]),
        S,
    )
    polls = metadata(spark, [
        {"channel": "a", "snapshot_at": at(-10), "title": "older"}, {"channel": "a", "snapshot_at": at(0), "title": "now"},
        {"channel": "b", "snapshot_at": at(-300), "title": "five minutes"},
        {"channel": "c", "snapshot_at": at(-300, -1), "title": "too old"},
        {"channel": "d", "snapshot_at": at(0, 1), "title": "too late"},
    ])
    got = {r["twitch_login"]: r["title"] for r in donations.by_title(moves, polls, S).collect()}
    assert got == {"a": "now", "b": "five minutes", "c": None, "d": None}
    spikes = {r["twitch_login"]: r["title"] for r in donations.spike_moments(
        moves, polls, chat.hourly_activity(messages(spark, [])), S).collect()}
    assert spikes == got


def test_liveness_needs_a_candidate(spark):
    claims = snapshots(spark, [{"twitch_login": c, "ingested_at": at(), "is_online": o}
                               for c, o in (("a", True), ("b", True), ("c", None), (None, True))])
    polls = metadata(spark, [{"channel": "a", "is_live": False}, {"channel": "c", "is_live": True}])
    got = {r["twitch_login"]: r["liveness_mismatch"] for r in streams.liveness_reconciliation(claims, polls, S).collect()}
    assert got == {"a": True, "b": False, "c": True, None: False}


def test_first_snapshot_has_no_move(spark):
    rows = donations.deltas(snapshots(spark, [
        {"twitch_login": "a", "ingested_at": at(0), "donation_amount_eur": 10},
        {"twitch_login": "a", "ingested_at": at(20), "donation_amount_eur": 12.5},
        {"twitch_login": None, "ingested_at": at(20), "donation_amount_eur": 99},
    ]), S).orderBy("ingested_at").collect()
    assert [(float(r["donation_delta_eur"]), r["seconds_since_prev_snapshot"]) for r in rows] == [(0.0, None), (2.5, 20.0)]


def test_rank_ties_and_null(spark):
    rows = donations.rank(snapshots(spark, [
        {"twitch_login": n, "ingested_at": at(), "donation_amount_eur": v} for n, v in (("a", 10), ("b", 10), ("c", 5), ("d", None))
    ]), S).collect()
    assert {r["twitch_login"]: r["donation_rank"] for r in rows} == {"d": 1, "a": 2, "b": 2, "c": 4}


def test_title_changes_and_segments(spark):
    polls = metadata(spark, [{"snapshot_at": at(i), "title": t, "category": None} for i, t in enumerate([None, None, "x"])])
    changes = streams.category_changes(polls, S).collect()
    assert [(r["prev_title"], r["new_title"]) for r in changes] == [(None, "x")]
    assert {r["segment_id"] for r in streams.title_segments(polls, S).collect()} == {0, 1}
    aaba = metadata(spark, [{"snapshot_at": at(i), "title": t} for i, t in enumerate("AABA")])
    got = sorted((r["segment_id"], r["title"], r["snapshot_count"]) for r in streams.title_segments(aaba, S).collect())
    assert got == [(1, "A", 2), (2, "B", 1), (3, "A", 1)]


def test_hop_gap_edges(spark):
    rows = []
    for who, gap, channel in (("x", 1800, "b"), ("y", 1800.000001, "b"), ("z", 10, "a")):
        rows += [{"chatter_id": who, "message_sent_at": at(0)}, {"chatter_id": who, "message_sent_at": at(gap), "channel": channel}]
    hops = chatters.channel_hops(chatters.timeline(messages(spark, rows), S), S).collect()
    assert [(r["chatter_id"], r["gap_seconds"]) for r in hops] == [("x", 1800.0)]


def test_profiles(spark):
    rows = [{"chatter_id": str(n), "channel": f"c{i}", "message_sent_at": T0} for n in (1, 2, 3, 4, 10, 11) for i in range(n)]
    got = {r["chatter_id"]: r["chatter_profile"] for r in chatters.profile(chatters.rollup(messages(spark, rows)), S).collect()}
    assert got == {"1": "sedentaire", "2": "multi_streamer", "3": "multi_streamer", "4": "semi_nomade", "10": "semi_nomade", "11": "nomade"}


@pytest.mark.parametrize(
    "text, signals",
    [
        (None, (0, 0, 0, 0, 0)), ("CONNARDS", (0, 1, 0, 0, 1)), ("xconnard", (0, 0, 0, 0, 0)), ("OK", (0, 0, 0, 0, 0)),
        ("!!!!", (1, 0, 0, 0, 0)), ("Superbe pogchamp", (0, 0, 1, 1, 0)), ("élove", (0, 0, 0, 0, 0)), ("ta gueule", (0, 0, 0, 0, 1)),
    ],
)
def test_mood(spark, text, signals):
    rows = [{"message_text": text, "message_sent_at": T0}] * 20 + [{"message_text": text, "channel": "few", "message_sent_at": T0}] * 19
    (r,) = chat.hourly_mood(messages(spark, rows), S).collect()
    assert r["channel"] == "a"
    assert tuple(r[c] for c in ("punct_rate", "caps_rate", "emote_rate", "positive_rate", "hostile_rate")) == signals


def test_spikes_need_variation(spark):
    flat = [{"message_sent_at": at(3600 * h)} for h in range(5)] + [{"channel": "single", "message_sent_at": T0}]
    assert chat.spikes(chat.hourly_activity(messages(spark, flat)), S).count() == 0


def test_single_instant_event_is_final_push(spark):
    snaps = snapshots(spark, [{"twitch_login": "a", "ingested_at": T0, "donation_amount_eur": 1}])
    (r,) = event.phase_rows(donations.deltas(snaps, S), snaps, S).collect()
    assert r["event_progress_pct"] is None and r["event_phase"] == "final_push"


def test_duration_buckets(spark):
    df = spark.createDataFrame([(0.0,), (3600.0,), (43199.0,), (43200.0,), (None,)], "s double")
    assert [r["b"] for r in df.select(streams.duration_bucket("s").alias("b")).collect()] == [1, 2, 12, 13, None]


def test_emote_tokens(spark):
    rows = [
        {"message_text": " both  both", "message_sent_at": T0, "emotes": {"25": 2}},
        {"message_text": "alien", "message_sent_at": T0}, {"message_text": None, "message_sent_at": T0, "emotes": {}},
    ]
    catalog = staging.emotes(table(spark, "emote_catalog", [
        {"service": "7tv", "scope": "channel", "channel": "a", "emote_id": "own", "emote_code": "both"},
        {"service": "bttv", "scope": "global", "channel": "__global__", "emote_id": "all", "emote_code": "both"},
        {"service": "7tv", "scope": "channel", "channel": "b", "emote_id": "other", "emote_code": "alien"},
        {"service": "twitch", "scope": "global", "channel": "__global__", "emote_id": "t", "emote_code": "both"},
    ]))
    got = {(r["service"], r["emote_id"]): r["usage_count"] for r in chat.emote_usage(messages(spark, rows), catalog).collect()}
    assert got == {("twitch", "25"): 2, ("7tv", "own"): 2, ("bttv", "all"): 2}


def _catalog(spark, rows):
    names = ("service", "scope", "channel", "emote_id", "emote_code")
    return staging.emotes(table(spark, "emote_catalog", [dict(zip(names, r, strict=True)) for r in rows]))


def test_emotes_with_several_codes_are_summed(spark):
    """Repeated catalog rows, two codes of one emote, an emote both global and a channel's, a channel named like the scope."""
    said = [("a", "x y y"), ("b", "x"), ("__global__", "y"), (None, "x")]
    sent = messages(spark, [{"channel": c, "message_text": t, "message_sent_at": T0} for c, t in said])
    catalog = _catalog(spark, [
        ("7tv", "channel", "a", "twice", "x"), ("7tv", "channel", "a", "twice", "x"), ("7tv", "channel", "a", "codes", "x"),
        ("7tv", "channel", "a", "codes", "y"), ("ffz", "channel", "a", "both", "y"), ("ffz", "global", "__global__", "both", "x"),
        ("bttv", "global", "__global__", "all", "y"), ("bttv", "global", "__global__", None, "x"), ("bttv", "channel", "a", "none", None),
    ])
    want = sorted([
        ("a", "7tv", "twice", 2), ("a", "7tv", "codes", 3), ("a", "ffz", "both", 3), ("a", "bttv", "all", 2), ("a", "bttv", "None", 1),
        ("b", "ffz", "both", 1), ("b", "bttv", "None", 1), ("__global__", "bttv", "all", 2), ("None", "ffz", "both", 1), ("None", "bttv", "None", 1),
    ])
    for bucket in ({}, {"bucket": None}):
        got = chat.emote_usage(sent, catalog, **bucket).collect()
        assert sorted((str(r["channel"]), r["service"], str(r["emote_id"]), r["usage_count"]) for r in got) == want


def test_emote_totals_do_not_grow_with_the_hours(spark):
    """Days, channels and coverage are counted from the messages: a plan of them never pairs an emote with every hour."""
    sent = messages(spark, [{"message_text": "x", "message_sent_at": at(3600 * h)} for h in range(24)])
    rows = [("7tv", "channel", "a", f"e{i}", "x") for i in range(50)]
    m = Models({"live_chat": sent, "emote_catalog": table(spark, "emote_catalog", [dict(zip(("service", "scope", "channel", "emote_id", "emote_code"), r, strict=True)) for r in rows])})
    assert m.emote_usage.count() == 24 * 50
    for name in ("emote_trends", "emote_catalog_coverage", "emote_catalog_utilization"):
        df = getattr(m, name)
        assert df.agg({"usage_count" if name == "emote_trends" else "total_usage_count": "sum"}).collect()[0][0] == 24 * 50
        assert "date_trunc(hour" not in df._jdf.queryExecution().executedPlan().toString()


def test_matches_of_one_code_are_spread(spark):
    """The parts of the join are not merged though its inputs are small, and no side of it is broadcast by its file size."""
    catalog = _catalog(spark, [("7tv", "channel", "a", f"e{i}", f"c{i}") for i in range(200)])
    sent = messages(spark, [{"message_text": " ".join(f"c{i}" for i in range(200)), "message_sent_at": T0}])
    used = chat.emote_usage(sent, catalog)
    used.count()
    assert used.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).filter(lambda n: n > 0).count() > 2


def test_bot_signal_needs_five_gaps(spark):
    rows = [{"chatter_id": who, "message_sent_at": at(10 * i)} for who, n in (("four", 5), ("five", 6)) for i in range(n)]
    m = Models({"live_chat": messages(spark, rows)})
    got = {r["chatter_id"]: (r["gap_count"], r["stddev_gap_seconds"]) for r in m.bot_signal.collect()}
    assert got == {"four": (None, None), "five": (5, 0.0)}


def test_session_midpoint_and_borders(spark):
    polls = metadata(spark, [{"stream_started_at": T0, "snapshot_at": at(s), "viewer_count": v, "duration_seconds": 1.0} for s, v in ((0, 10), (100, 30))])
    chat_rows = messages(spark, [{"message_sent_at": at(s)} for s in (-1, 0, 49, 50, 100, 101)])
    moves = donations.deltas(snapshots(spark, []), S)
    (r,) = streams.session_analysis(polls, streams.sessions(polls), chat_rows, moves, S).collect()
    assert (r["message_count_first_half"], r["message_count_second_half"], r["viewer_change"]) == (2, 2, 20)


def test_global_rank_counts_rows(spark):
    rows = [{"chatter_id": "top", "channel": c, "message_sent_at": T0} for c in "abc"] + [{"chatter_id": "next", "message_sent_at": T0}]
    m = Models({"live_chat": messages(spark, rows)})
    assert {r["chatter_id"]: r["rank_global"] for r in m.chatter_leaderboard.collect()} == {"top": 1, "next": 4}


def test_latest_identity_prefers_messages_without_time(spark):
    rows = [{"chatter_id": "x", "chatter": "old", "message_sent_at": at(0)}, {"chatter_id": "x", "chatter": "new", "message_sent_at": at(5)}]
    assert chatters.rollup(messages(spark, rows)).collect()[0]["chatter"] == "new"
    rows.append({"chatter_id": "x", "chatter": "timeless"})
    assert chatters.rollup(messages(spark, rows)).collect()[0]["chatter"] == "timeless"


def test_materialized_models_are_read_back(spark, tmp_path):
    rows = [{"chatter_id": "x", "message_sent_at": at(i)} for i in range(3)]
    m = Models({"live_chat": messages(spark, rows)}).materialize(["stg_chat"], str(tmp_path))
    assert "FileScan parquet" in m.chat_hourly_activity._jdf.queryExecution().toString()
    assert m.chat_hourly_activity.collect()[0]["message_count"] == 3


def test_streamer_with_two_broadcasters_fans_out(spark):
    """Kept as it is upstream; the uniqueness rule reports it."""
    from streamtally.plans import quality

    polls = metadata(spark, [{"broadcaster_id": b, "stream_started_at": T0} for b in "xy"])
    snaps = snapshots(spark, [{"twitch_login": "a", "ingested_at": T0, "donation_amount_eur": 1}])
    m = Models({})
    m.__dict__.update(stg_metadata=polls, stg_snapshots=snaps, stg_chat=messages(spark, []))
    assert m.streamer_profile.count() == 2
    rule = [r for r in quality.RULES if r.model == "streamer_profile" and r.check == "unique"]
    assert [r["violations"] for r in quality.report(m, rule).collect()] == [1]


def test_rules_name_existing_models():
    from streamtally.plans import quality

    assert all(hasattr(Models, r.model) for r in quality.RULES)


def test_quality_report_finds_every_kind_of_violation(spark):
    """One violating row per kind of rule, in one read of the model; repeats, nulls and tiny time differences."""
    from types import SimpleNamespace

    from streamtally.plans import quality

    ddl = "id bigint, batch_id string, row_number int, service string, amount decimal(10,2), at timestamp"
    t = dt.datetime(2024, 1, 1, 12, 0, 0)
    given = [
        (1, "a", 0, "7tv", Decimal("1.00"), t), (1, "a", 1, "7tv", Decimal("-0.01"), t + dt.timedelta(microseconds=1)), (None, None, 2, "odd", None, None),
        (None, None, 2, "odd", Decimal("5.00"), None), (3, "b", 0, None, Decimal("9.99"), t + dt.timedelta(microseconds=2)),
    ]
    rules = [
        quality.Rule("m", "unique", ("id",)), quality.Rule("m", "unique", ("batch_id", "row_number")), quality.Rule("m", "unique", ("at",)),
        quality.Rule("m", "not_null", ("id",)), quality.Rule("m", "accepted_values", ("service",), ("7tv",)),
        quality.Rule("m", "between", ("amount",), severity="warn", bounds=(0, 9)), quality.Rule("n", "not_null", ("id",)), quality.Rule("n", "unique", ("id",)),
    ]
    rows = spark.createDataFrame(given, ddl)
    report = quality.report(SimpleNamespace(m=rows, n=rows.limit(0)), rules)
    got = [(r["model"], r["check"], r["columns"], r["severity"], r["violations"]) for r in report.collect()]
    assert sorted(got) == sorted([
        ("m", "unique", "id", "error", 1), ("m", "unique", "batch_id,row_number", "error", 1), ("m", "unique", "at", "error", 0),
        ("m", "not_null", "id", "error", 2), ("m", "accepted_values", "service", "error", 1), ("m", "between", "amount", "warn", 2),
        ("n", "not_null", "id", "error", 0), ("n", "unique", "id", "error", 0),
    ])
    for rule in rules:
        assert rule.violations(rows if rule.model == "m" else rows.limit(0)).count() == next(v for m, c, n, _, v in got if (m, c, n) == (rule.model, rule.check, ",".join(rule.columns)))
