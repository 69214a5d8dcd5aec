"""Streaming jobs over several micro-batches: replays, restarts, late rows."""

import json
import random
from collections import Counter

from pyspark.sql import functions as F

from streamtally import Settings
from streamtally.schemas import LIVE_CHAT
from streamtally.sources.stores import scan_bronze, without_synthetic
from streamtally.sources.table_log import Table
from streamtally.streaming import ingest, previous, windows
from streamtally.streaming.run import drain
from tests.test_edges import T0, at, messages

S = Settings()


def feed(spark, path, *batches):
    """A file stream that delivers each list of chat rows as its own micro-batch."""
    for i, rows in enumerate(batches):
        numbered = [{"id": 100 * i + j, "batch_id": "b", "row_number": 100 * i + j, **r} for j, r in enumerate(rows)]
        messages(spark, numbered).coalesce(1).write.mode("append").parquet(f"{path}/{i}")
    return (
        spark.readStream.schema(LIVE_CHAT).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(path))
    )


def test_dedup_across_micro_batches(spark, tmp_path):
    row = {"batch_id": "b", "row_number": 1, "captured_at": T0}
    out = drain(spark, windows.dedup(feed(spark, tmp_path, [row, row], [row, {**row, "row_number": 2}])))
    assert sorted(r["row_number"] for r in out.collect()) == [1, 2]


def test_open_hours_show_and_late_rows_are_dropped(spark, tmp_path):
    hour = 3600
    stream = feed(
        spark, tmp_path,
        [{"chatter_id": "x", "message_sent_at": at(0)}, {"chatter_id": "x", "message_sent_at": at(1)}],
        [{"chatter_id": "y", "message_sent_at": at(50)}, {"chatter_id": "x", "message_sent_at": at(3 * hour)}],
        [{"chatter_id": "x", "message_sent_at": at(6 * hour)}],
        # The hour was emitted with the batch before; a row for it is too late now.
        [{"chatter_id": "late", "message_sent_at": at(60)}, {"chatter_id": "x", "message_sent_at": at(9 * hour)}],
    )
    hours = windows.hourly_chat(drain(spark, windows.hourly_chat_parts(stream), windows.HOUR_KEYS))
    got = {r["hour_bucket"]: (r["message_count"], r["unique_chatter_count"]) for r in hours.collect()}
    # The last hour is still open and shows what it has.
    assert got == {T0: (3, 2), at(3 * hour): (1, 1), at(6 * hour): (1, 1), at(9 * hour): (1, 1)}


def test_previous_row_across_micro_batches_and_late_rows(spark, tmp_path):
    stream = feed(
        spark, tmp_path / "in",
        [{"chatter_id": "x", "channel": "a", "message_sent_at": at(0)}],
        [{"chatter_id": "x", "channel": "b", "message_sent_at": at(10)}],
        [{"chatter_id": "x", "channel": "c", "message_sent_at": at(5)}, {"chatter_id": "x", "channel": "a", "message_sent_at": at(20)}],
    )
    root = str(tmp_path / "job")
    previous.start(stream, previous.CHANNEL_HOPS, root, S).awaitTermination()
    hops = previous.read(stream, previous.CHANNEL_HOPS, root, S).collect()
    assert sorted((r["from_channel"], r["to_channel"], r["gap_seconds"]) for r in hops) == [("a", "c", 5.0), ("b", "a", 10.0), ("c", "b", 5.0)]


def test_previous_row_of_a_hot_key_out_of_order(spark, tmp_path):
    """Eight micro-batches in no order, one chatter with a third of the rows, cut into slices."""
    rng = random.Random(4)
    rows = [{"chatter_id": "hot" if i % 3 == 0 else f"c{i % 7}", "channel": rng.choice("abc"), "message_sent_at": at(i // 2)} for i in range(120)]
    order = list(range(120))
    rng.shuffle(order)
    feeds = [[{**rows[i], "id": i, "row_number": i} for i in order[k::8]] for k in range(8)]
    tight, root = Settings(hot_key_rows=10, hot_slice_rows=5), str(tmp_path / "job")
    stream = feed(spark, tmp_path / "in", *feeds)
    previous.start(stream, previous.CHANNEL_HOPS, root, tight).awaitTermination()
    got = Counter((r["chatter_id"], r["from_channel"], r["to_channel"], r["departed_at"], r["arrived_at"]) for r in previous.read(stream, previous.CHANNEL_HOPS, root, tight).collect())
    want = Counter()
    for name in {r["chatter_id"] for r in rows}:
        own = [r for r in rows if r["chatter_id"] == name]
        want.update((name, a["channel"], b["channel"], a["message_sent_at"], b["message_sent_at"]) for a, b in zip(own, own[1:]) if a["channel"] != b["channel"])
    assert got == want


def test_previous_row_writes_only_what_changes(spark, tmp_path):
    """Sixteen micro-batches in no order, some rows delivered twice: a stored row is derived again if a new one comes before it."""
    rng = random.Random(6)
    rows = [{"id": i, "row_number": i, "chatter_id": f"c{i % 3}", "channel": rng.choice("abc"), "message_sent_at": at(i // 2)} for i in range(160)]
    order = list(range(160))
    rng.shuffle(order)
    feeds = [[rows[i] for i in [*order[k::16], order[k], order[k - 1]]] for k in range(16)]
    root, stream = str(tmp_path / "job"), feed(spark, tmp_path / "in", *feeds)
    previous.start(stream, previous.CHANNEL_HOPS, root, S).awaitTermination()
    got = Counter((r["chatter_id"], r["from_channel"], r["to_channel"], r["departed_at"], r["arrived_at"]) for r in previous.read(stream, previous.CHANNEL_HOPS, root, S).collect())
    want = Counter()
    for name in ("c0", "c1", "c2"):
        own = [r for r in rows if r["chatter_id"] == name]
        want.update((name, a["channel"], b["channel"], a["message_sent_at"], b["message_sent_at"]) for a, b in zip(own, own[1:]) if a["channel"] != b["channel"])
    assert got == want
    written = Table(spark, f"{root}/out", "id long").read().count()
    assert written <= 2 * sum(map(len, feeds))


def test_stalled_channels(spark, tmp_path):
    seen = drain(spark, windows.last_seen(feed(spark, tmp_path, [{"captured_at": at(0)}, {"channel": "b", "captured_at": at(400)}])), ["channel"])
    alerts = windows.stalled(seen, F.lit(at(600)), 5).collect()
    assert [(r["channel"], r["silent_minutes"]) for r in alerts] == [("a", 10.0)]


def envelope(stream, batch, rows):
    sent = [{"row_number": i, "batch_id": batch, **r} for i, r in enumerate(rows)]
    return json.dumps({"source": "t", "stream": stream, "batch_id": batch, "batched_at": "2024-01-01T00:00:00.000000+00:00", "rows": sent})


def test_ingest_replay_restart_and_upsert(spark, tmp_path):
    inbox, root, checkpoint = (str(tmp_path / n) for n in ("inbox", "bronze", "checkpoint"))

    def deliver(*lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(inbox)
        stream = spark.readStream.option("maxFilesPerTrigger", 1).text(inbox)
        ingest.start(stream, root, checkpoint, S, every=None).awaitTermination()

    emote = {"service": "7tv", "scope": "global", "channel": "__global__", "emote_id": "1", "emote_code": "old", "fetched_at": "2024-01-01T00:00:00.000000+00:00"}
    other = {**emote, "emote_id": "2"}
    chat_one = envelope("live_chat", "b1", [{"channel": "a", "message_text": "hi", "emotes": '{"25":1}'}, {"channel": "b"}])
    deliver(chat_one, envelope("emote_catalog", "e1", [emote, other]))
    deliver(chat_one, envelope("live_chat", "b2", [{"channel": "stress-test-7"}, {"chatter": "no channel"}]), "garbage")
    newer = {**emote, "emote_code": "new", "fetched_at": "2024-01-02T00:00:00.000000+00:00"}
    deliver(envelope("emote_catalog", "e2", [newer]), envelope("weather", "w1", [{"x": 1}]))

    chat = ingest.stored(spark, root, "live_chat")
    assert sorted((r["batch_id"], r["row_number"], r["channel"]) for r in chat.collect()) == [
        ("b1", 0, "a"), ("b1", 1, "b"), ("b2", 0, "stress-test-7")
    ]
    assert without_synthetic(chat).count() == 2
    assert {r["emote_id"]: r["emote_code"] for r in ingest.current(spark, root, "emote_catalog").collect()} == {"1": "new", "2": "old"}
    reasons = sorted(r["reason"] for r in spark.read.parquet(f"{root}/quarantine").collect())
    assert reasons == ["required field missing", "unknown stream", "unreadable envelope"]

    # The reader of bronze tables sees one version of a latest-state table, and ids in the order of arrival.
    assert scan_bronze(spark, root, "emote_catalog").count() == 2
    ids = [(r["batch_id"], r["row_number"]) for r in scan_bronze(spark, root, "live_chat").orderBy("id").collect()]
    assert ids == [("b1", 0), ("b1", 1), ("b2", 0)]

    # A micro-batch that is run again writes the same rows in the same place.
    before = sorted(r["message_text"] or "" for r in chat.collect())
    ingest.store_batch(spark.createDataFrame([(chat_one,)], "value string"), 0, root, S)
    again = ingest.stored(spark, root, "live_chat")
    assert again.where("batch_id = 'b1'").count() == 2 and sorted(r["message_text"] or "" for r in again.collect()) == before


def test_streams_work_as_batch_functions(spark):
    rows = messages(spark, [{"chatter_id": "x", "message_sent_at": at(0)}, {"chatter_id": "x", "channel": "b", "message_sent_at": at(1)}])
    assert windows.quarter_hours(windows.quarter_hour_parts(rows)).collect()[0]["distinct_channel_count"] == 2
    assert windows.running_counts(rows).count() == 2 and windows.channel_running_counts(rows).count() == 2
