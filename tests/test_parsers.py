"""Literal inputs for every parser."""

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from streamtally import Settings
from streamtally.plans import staging
from streamtally.sources import chat_lines, emote_apis, envelopes, event_api, replay, stores

S = Settings()


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("founder/0,premium/1", {"founder": "0", "premium": "1"}),
        (None, {}),
        ("", {}),
        ("bits/100,broken", {"bits": "100"}),
        ("vip/1,vip/2", {"vip": "2"}),
    ],
)
def test_badges(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "raw string")
    assert one(df.select(chat_lines.badges_of("raw").alias("m")))["m"] == expected


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("7:0-2,9-11/88:4-6", {"7": 2, "88": 1}),
        ("61:5-9", {"61": 1}),
        (None, {}),
        ("", {}),
        ("25:/1902", {}),
        ("25:,/7:1-2,", {"7": 1}),
    ],
)
def test_emotes(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "raw string")
    assert one(df.select(chat_lines.emotes_of("raw").alias("m")))["m"] == expected


def test_chat_lines(spark):
    lines = [
        ("@display-name=Ada_L;user-id=815;tmi-sent-ts=1710000000000 :ada_l!ada_l@host PRIVMSG #event :good evening",),
        (":ada_l!ada_l@host PRIVMSG #event :good: night",),
        ("PING :host",),
        (":host 001 justin :Welcome",),
    ]
    parsed = chat_lines.parse_chat_lines(spark.createDataFrame(lines, "value string")).orderBy("text").collect()
    assert [(r["nick"], r["channel"], r["text"]) for r in parsed] == [
        ("ada_l", "event", "good evening"),
        ("ada_l", "event", "good: night"),
    ]
    assert parsed[0]["tags"] == {"display-name": "Ada_L", "user-id": "815", "tmi-sent-ts": "1710000000000"}
    assert parsed[1]["tags"] is None


def test_chat_rows_fall_back_to_nick_and_capture_time(spark):
    at = dt.datetime(2024, 1, 1)
    lines = [
        (at, "@display-name=;tmi-sent-ts=1700000000000 :a!a@h PRIVMSG #Known :x"),
        (at, ":b!b@h PRIVMSG #known :y"),
        (at, ":c!c@h PRIVMSG #other :z"),
    ]
    parsed = chat_lines.parse_chat_lines(spark.createDataFrame(lines, "captured_at timestamp, value string"))
    roster = spark.createDataFrame([("KNOWN",)], "channel string")
    rows = chat_lines.build_chat_rows(parsed, roster, "captured_at").orderBy("message_text").collect()
    assert [(r["channel"], r["chatter"]) for r in rows] == [("KNOWN", "a"), ("KNOWN", "b")]
    assert rows[0]["message_sent_at"].timestamp() == 1700000000
    assert rows[1]["message_sent_at"] == at and rows[1]["badges"] == {} and rows[1]["emotes"] == {}


def test_control_characters_do_not_shift_the_parts(spark):
    line = "@k=v\u0001w :ni\u0001ck!n@h PRIVMSG #ch\u0001an :te\u0001xt"
    r = one(chat_lines.parse_chat_lines(spark.createDataFrame([(line,)], "value string")))
    assert (r["tags"], r["nick"], r["channel"], r["text"]) == ({"k": "v\u0001w"}, "ni\u0001ck", "ch\u0001an", "te\u0001xt")


def test_nameless_messages_meet_no_account(spark):
    ddl = "channel string, message_text string, captured_at timestamp, chatter_id string"
    at = dt.datetime(2024, 1, 2)
    rows = spark.createDataFrame([("c", "hi", at, None), ("c", "hi", at, ""), ("c", "yo", at, "7")], ddl)
    facts = [(None, at, "x", at), ("7", at, "partner", at), ("", at, "empty", at)]
    accounts = spark.createDataFrame(facts, "chatter_id string, account_created_at timestamp, broadcaster_type string, resolved_at timestamp")
    got = {(r["message_text"], r["chatter_id"]): r["broadcaster_type"] for r in chat_lines.enrich_accounts(rows, accounts).collect()}
    assert got == {("hi", None): None, ("hi", ""): "empty", ("yo", "7"): "partner"}


@pytest.mark.parametrize("inner", ["a\u2028b", "a\u2029b", "a\u0085b", "a\rb", "\u0001ACTION waves\u0001", "a\u000bb"])
def test_only_a_line_feed_ends_a_line(spark, inner):
    df = spark.createDataFrame([(f":n!n@h PRIVMSG #c :{inner}{end}",) for end in ("", "\r", "\n", "\r\n")], "value string")
    assert [r["text"] for r in chat_lines.parse_chat_lines(df).collect()] == [inner] * 4


def on_stage(login, cents, online=True, watching=None):
    """A streamer as the event's site reports it: amounts and counts are wrapped in an object."""
    return {
        "twitch_id": f"id-{login}".lower(), "twitch": login, "display": login.title(), "profileUrl": f"/{login}", "online": online,
        "game": "Chess", "viewersAmount": {"number": watching}, "donationAmount": {"number": cents / 100},
    }


def site(mode, *streamers):
    """The site's document; totals follow from its streamers."""
    raised = sum(s["donationAmount"]["number"] for s in streamers)
    watching = sum(s["viewersAmount"]["number"] or 0 for s in streamers)
    return json.dumps({"websiteMode": mode, "donationAmount": {"number": raised}, "viewersCount": {"number": watching}, "live": list(streamers)})


@pytest.fixture(scope="module")
def polled(spark):
    """Three streamers, nobody, and a document that was cut off."""
    full = site("night", on_stage("Ada", 12_34, watching=7), on_stage("bob", 0, online=False), on_stage("CY", 5, watching=30))
    return event_api.parse_event_snapshot(spark.createDataFrame([(1, full), (2, site("night")), (3, full[:40])], "id bigint, body string"))


def test_event_snapshot(polled):
    full, nobody, cut = polled.orderBy("id").collect()
    assert (full["website_mode"], full["total_donation_amount_eur"], full["total_viewer_count"]) == ("night", 12.39, 37)
    assert [(s["twitch_login"], str(s["donation_amount_eur"]), s["viewer_count"]) for s in full["streamers"]] == [("Ada", "12.34", 7), ("bob", "0.00", None), ("CY", "0.05", 30)]
    assert nobody["streamers"] == [] and nobody["total_viewer_count"] == 0
    assert cut["streamers"] is None


def test_snapshots_without_streamers_vanish(polled):
    rows = staging.snapshots(polled.selectExpr("*", "'b' as batch_id", "1 as row_number", "timestamp'2024-01-01' as ingested_at")).collect()
    assert [(r["snapshot_id"], r["twitch_login"], r["is_online"]) for r in rows] == [(1, "ada", True), (1, "bob", False), (1, "cy", True)]


EVENTS = "id string, name string, schedule struct<start: string, end: string>"


def test_latest_event(spark):
    rows = [("1", "Marathon 2023", ("2023-09-01", "x")), ("2", "Marathon 2025", ("2025-09-01", "x")), ("3", "Birds", ("2026-01-01", "x"))]
    assert one(event_api.latest_event(spark.createDataFrame(rows, EVENTS), "Marathon"))["id"] == "2"


def test_no_event_is_an_error(spark):
    with pytest.raises(PySparkException, match="no event named"):
        event_api.latest_event(spark.createDataFrame([("3", "Birds", ("2026", "x"))], EVENTS), "Marathon").collect()


def test_goal_rows(spark):
    part = spark.createDataFrame(
        [("p1", "One", 1, (("t1", "one"),)), ("p2", "Two", 1, (None,)), ("p3", "Three", 1, None), ("p4", "Four", 0, None)],
        "id string, name string, donation_goals_count int, socials struct<twitch: struct<id: string, login: string>>",
    )
    goals = spark.createDataFrame(
        [(p, f"g{p}", "goal", 300000, "c", True) for p in ("p1", "p2", "p3", "p4")],
        "participation_id string, id string, name string, amount bigint, category string, accomplished boolean",
    )
    at = F.lit("2024-01-01").cast("timestamp")
    built = event_api.build_goal_rows(part, goals, at)
    assert "accomplished" not in built.columns
    rows = {r["participation_id"]: r for r in built.collect()}
    assert set(rows) == {"p1", "p2", "p3"} and float(rows["p1"]["goal_amount_eur"]) == 3000.0
    assert rows["p1"]["twitch_login"] == "one" and rows["p2"]["twitch_login"] is None and rows["p3"]["twitch_id"] is None


def test_emote_documents(spark):
    docs = [
        ("twitch", "channel", {"data": [{"id": "1", "name": "Kappa"}]}),
        ("7tv", "global", {"emotes": [{"id": "g", "name": "o7"}]}),
        ("7tv", "channel", {"emote_set": None}),
        ("bttv", "global", [{"id": "b", "code": ":tf:"}]),
        ("bttv", "channel", {"channelEmotes": [{"id": "c", "code": "C"}], "sharedEmotes": [{"id": "s", "code": "S"}]}),
        ("ffz", "global", {"default_sets": [3, 9], "sets": {"3": {"emoticons": [{"id": 4711, "name": "Wow"}]}, "4": {"emoticons": [{"id": 1, "name": "No"}]}}}),
        ("ffz", "channel", {"sets": {"4": {"emoticons": [{"id": 1, "name": "Yes"}]}}}),
    ]
    rows = [(s, c, "ch", None, json.dumps(b)) for s, c, b in docs] + [("bttv", "channel", "ch", None, "{broken")]
    df = spark.createDataFrame(rows, "service string, scope string, channel string, fetched_at timestamp, body string")
    got = {(r["service"], r["scope"], r["emote_id"], r["emote_code"]) for r in emote_apis.parse_emote_catalogs(df).collect()}
    assert got == {
        ("twitch", "channel", "1", "Kappa"), ("7tv", "global", "g", "o7"), ("bttv", "global", "b", ":tf:"),
        ("bttv", "channel", "c", "C"), ("bttv", "channel", "s", "S"), ("ffz", "global", "4711", "Wow"),
        ("ffz", "channel", "1", "Yes"),
    }


def test_envelopes_route_and_quarantine(spark):
    def envelope(stream, rows, batch="b1"):
        return (json.dumps({"source": "s", "stream": stream, "batch_id": batch, "batched_at": "2024-01-01T00:00:00.000000+00:00", "rows": rows}),)

    sent = [
        envelope("live_chat", [
            {"row_number": 0, "channel": "a", "badges": '{"vip":"1","vip":"2"}', "emotes": '{"25":2}', "captured_at": "2024-01-01T00:00:00.123456+00:00"},
            {"row_number": 1, "chatter": "nobody"},
            {"row_number": 2, "channel": "a", "captured_at": "soon"},
        ]),
        envelope("weather", [{"x": 1}], "b2"),
        ("not json",),
    ]
    rows = envelopes.explode_envelope(spark.createDataFrame(sent, "value string"))
    kept = one(envelopes.typed_rows(rows, "live_chat"))
    assert (kept["batch_id"], kept["row_number"], kept["channel"]) == ("b1", 0, "a")
    assert kept["badges"] == {"vip": "2"} and kept["emotes"] == {"25": 2}
    assert kept["captured_at"] == dt.datetime(2024, 1, 1, 0, 0, 0, 123456)
    rejected = {(r["batch_id"], r["row_number"], r["reason"]) for r in envelopes.quarantine(rows).collect()}
    assert rejected == {
        ("b1", 1, "required field missing"), ("b1", 2, "malformed row"), ("b2", 0, "unknown stream"),
        (None, 0, "unreadable envelope"),
    }
    routes = {r["stream"]: r["route"] for r in envelopes.route_by_stream(rows).collect()}
    assert routes == {"live_chat": "insert", "weather": "quarantine", None: "quarantine"}


def test_replay_recovery(spark, tmp_path):
    def comment(i, badges=(), fragments=()):
        return {
            "_id": f"c{i}", "created_at": f"2024-01-01T00:00:0{i}.500Z", "commenter": {"display_name": f"N{i}", "_id": str(i), "created_at": "2020-01-01T00:00:00Z"},
            "message": {"body": f"m{i}", "user_badges": [{"_id": b, "version": "1"} for b in badges],
                        "fragments": [{"text": "t", "emoticon": {"emoticon_id": f} if f else None} for f in fragments]},
        }

    for name, n in (("x", 2), ("y", 3)):
        doc = {"streamer": {"login": name, "id": 1}, "video": {"id": name}, "comments": [comment(i, ["vip"], ["9", None, "9"]) for i in range(n)]}
        (tmp_path / f"{name}.json").write_text(json.dumps(doc, indent=1))
    rows = replay.recover_replay_chat(replay.read_replays(spark, str(tmp_path)), "again").collect()
    assert sorted((r["batch_id"], r["row_number"]) for r in rows) == [("again/x/x", 0), ("again/x/x", 1), ("again/y/y", 0), ("again/y/y", 1), ("again/y/y", 2)]
    assert {r["channel"] for r in rows} == {"x", "y"}
    assert all(r["badges"] == {"vip": "1"} and r["emotes"] == {"9": 2} for r in rows)
    assert {r["message_sent_at"].microsecond for r in rows} == {500000}

    # Recovered again with one more file: every message keeps its name, so a replay check stores only the new ones.
    doc = {"streamer": {"login": "a", "id": 1}, "video": {"id": "a"}, "comments": [comment(i) for i in range(4)]}
    (tmp_path / "a.json").write_text(json.dumps(doc, indent=1))
    before = spark.createDataFrame([(r["batch_id"], r["row_number"]) for r in rows], "batch_id string, row_number int")
    again = replay.recover_replay_chat(replay.read_replays(spark, str(tmp_path)), "again").select("batch_id", "row_number")
    assert {tuple(r) for r in stores.append_dedup(before, again, S).collect()} == {("again/a/a", i) for i in range(4)}


def comment(i, body="hi"):
    return {
        "_id": f"c{i}", "created_at": f"2024-01-01T00:00:{i % 60:02d}Z", "channel_id": "1", "content_offset_seconds": i,
        "commenter": {"display_name": f"N{i}", "_id": f"u{i}", "name": f"n{i}", "created_at": "2020-01-01T00:00:00Z"},
        "message": {"body": body, "fragments": [{"text": body}], "user_badges": [{"_id": "vip", "version": "1"}]},
    }


@pytest.mark.parametrize("block", ["200b", "1k", "128m"])
@pytest.mark.parametrize("indent", [None, 2])
def test_replay_files_are_read_in_blocks(spark, tmp_path, block, indent):
    quoted = 'he said "content_offset_seconds": 7, {"comments": [ and left \\'
    about = {"streamer": {"name": "S", "login": "s", "id": 1}, "video": {"id": "v1"}}
    files = {
        "a": {**about, "comments": [comment(i, quoted if i % 5 == 0 else "x" * (i * 7)) for i in range(60)]},
        "b": {"comments": [comment(i) for i in range(3)], "streamer": {"name": "T", "login": "t", "id": 2}, "video": {"id": "v2"}},
        "c": {**about, "comments": []},
    }
    for name, document in files.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(document, indent=indent))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        read = replay.read_comments(spark, str(tmp_path))
        got = {(r["streamer"]["login"], r["video"]["id"], r["row_number"]): (r["_c"]["_id"], r["_c"]["message"]["body"], r["_c"]["commenter"]["_id"]) for r in read.collect()}
        tasks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {
        (d["streamer"]["login"], d["video"]["id"], i): (c["_id"], c["message"]["body"], c["commenter"]["_id"])
        for d in files.values() for i, c in enumerate(d["comments"])
    }
    assert got == want and (tasks > 20 or block != "200b")


def test_a_broken_replay_is_an_error(spark, tmp_path):
    (tmp_path / "x.json").write_text(json.dumps({"comments": [comment(1)]})[:-60])
    with pytest.raises(PySparkException, match="cannot be read"):
        replay.read_comments(spark, str(tmp_path)).collect()


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_replay_files_are_cut_twice_and_comments_move_once(spark, tmp_path):
    """Once for what stands between blocks and once for the comments, which are shuffled for one join."""
    text = planned(replay.read_comments(spark, str(tmp_path)))
    assert text.count("MapInArrow") == 2 and text.count("SortMergeJoin") + text.count("HashJoin") == 1


def test_rows_are_judged_in_one_pass(spark, tmp_path):
    path = str(tmp_path / "sent")
    spark.createDataFrame([("x",)], "value string").write.parquet(path)
    rows = envelopes.explode_envelope(spark.read.parquet(path))
    assert planned(envelopes.quarantine(rows)).count("FileScan parquet") == 1
    # A filter on the parsed text has it as a column, not the parsing again.
    filters = [line for line in planned(envelopes.typed_rows(rows, "live_chat")).splitlines() if "Filter" in line]
    assert filters and not any("from_json" in line for line in filters)
