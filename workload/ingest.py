"""Registered queries for sources, sinks, quality rules and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamtally import Models, Settings
from streamtally.plans import quality, staging
from streamtally.session import configure, release_shuffles, scratch_dir
from streamtally.sources import chat_lines, emote_apis, envelopes, event_api, polls, replay, stores
from streamtally.sources.files import names
from streamtally.streaming import alerts, ingest, previous, rolling, windows
from streamtally.streaming.run import deliver, drain, drained
from workload import raw, tables

S = Settings()


def _base(spark: SparkSession, d: str) -> DataFrame:
    return tables.base(configure(spark), d)


def _part(spark: SparkSession, d: str) -> DataFrame:
    return tables.read(configure(spark), d, "part")


# Sources ---------------------------------------------------------------------------


def parse_chat_lines(spark, d):
    return chat_lines.parse_chat_lines(raw.chat_lines(_base(spark, d)))


def parse_badges(spark, d):
    wire = tables.chat_wire(_base(spark, d))
    return wire.select("id", chat_lines.badges_of("badges_tag").alias("badges"))


def parse_emotes(spark, d):
    wire = tables.chat_wire(_base(spark, d))
    return wire.select("id", chat_lines.emotes_of("emotes_tag").alias("emotes"))


def build_chat_rows(spark, d):
    b = _base(spark, d)
    return chat_lines.build_chat_rows(parse_chat_lines(spark, d), raw.roster(b), "captured_at")


def enrich_accounts(spark, d):
    return chat_lines.enrich_accounts(build_chat_rows(spark, d), raw.accounts(_base(spark, d))).select(
        "id", "chatter_id", "account_created_at", "broadcaster_type"
    )


def pending_accounts(spark, d):
    return chat_lines.pending_accounts(build_chat_rows(spark, d), raw.accounts(_base(spark, d)))


def parse_event_snapshot(spark, d):
    return staging.snapshots(event_api.parse_event_snapshot(raw.event_documents(_base(spark, d))))


def latest_event(spark, d):
    events = raw.events_list(tables.read(configure(spark), d, "orders"))
    return event_api.latest_event(events, "Marathon").select("id", "name", F.col("schedule.start").alias("start"))


def build_goal_rows(spark, d):
    supplier = tables.read(configure(spark), d, "supplier")
    return event_api.build_goal_rows(
        raw.participations(supplier), raw.goals(_part(spark, d)), F.lit("2024-01-01 00:00:00").cast("timestamp")
    )


def parse_emote_catalogs(spark, d):
    return emote_apis.parse_emote_catalogs(raw.emote_responses(_part(spark, d)))


def flatten_emote_sets(spark, d):
    shape = "sets map<string, struct<emoticons: array<struct<id: string, name: string>>>>"
    sets = F.from_json("body", shape)["sets"]
    chosen = emote_apis.flatten_emote_sets(sets, F.array(F.lit("3"), F.lit("9")))
    ffz = raw.emote_responses(_part(spark, d)).where("service = 'ffz'")
    return ffz.select("channel", F.inline(chosen).alias("emote_id", "emote_code"))


def merge_channel_emote_lists(spark, d):
    own = raw.emote_responses(_part(spark, d)).where("scope = 'channel' and service in ('7tv', 'bttv')")
    return own.select("service", "channel", F.inline(emote_apis.emote_list("body")).alias("emote_id", "emote_code"))


def emote_catalog_counts(spark, d):
    return emote_apis.emote_catalog_counts(tables.emote_catalog(_part(spark, d)))


def build_metadata_snapshots(spark, d):
    return polls.build_metadata_snapshots(*raw.live_streams(_base(spark, d)), S)


def poll_summary(spark, d):
    return polls.poll_summary(build_metadata_snapshots(spark, d))


def stream_end_events(spark, d):
    return polls.stream_end_events(tables.metadata_snapshots(_base(spark, d)), S)


def roster_additions(spark, d):
    snapshots = tables.models(spark, d).stg_snapshots
    known = snapshots.where("twitch_id in ('t0', 't2', 't4', 't6')").select(F.col("twitch_login").alias("channel"))
    return polls.roster_additions(snapshots, known.distinct())


def recover_replay_chat(spark, d):
    documents = raw.replay_documents(tables.read(configure(spark), d, "conversations"))
    return replay.recover_replay_chat(documents, "recovered")


def recover_replay_files(spark, d):
    """The same documents from files, each read in blocks of four kilobytes by as many tasks."""
    root = scratch_dir(configure(spark), "replays")
    documents = raw.replay_documents(tables.read(spark, d, "conversations"))
    named = documents.select(F.to_json(F.struct(*documents.columns), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("value"), F.col("video.id").alias("video_id"))
    named.write.partitionBy("video_id").text(root)
    return replay.recover_comments(replay.read_comments(spark, root), "recovered")


# Envelopes and stores --------------------------------------------------------------


def explode_envelope(spark, d):
    rows = envelopes.explode_envelope(raw.chat_envelopes(_base(spark, d)))
    return rows.select(
        "stream", "batch_id", "row_number", "readable",
        F.get_json_object("payload", "$.row_number").cast("int").alias("own_number"),
        F.get_json_object("payload", "$.channel").alias("channel"),
    )


def typed_chat_rows(spark, d):
    rows = envelopes.explode_envelope(raw.chat_envelopes(_base(spark, d)))
    return envelopes.typed_rows(rows, "live_chat")


def route_by_stream(spark, d):
    b, part = _base(spark, d), _part(spark, d)
    chat, emotes = raw.chat_envelopes(b), raw.emote_envelopes(part)
    other = emotes.select(F.replace("value", F.lit("emote_catalog"), F.lit("weather")).alias("value"))
    rows = envelopes.explode_envelope(chat.unionByName(emotes).unionByName(other))
    return envelopes.route_by_stream(rows).groupBy("stream", "route").agg(F.count(F.lit(1)).alias("row_count"))


def quarantine(spark, d):
    """A row in 17 lacks its channel, one in 19 has no readable time; a third source is unknown."""
    def harm(value):
        value = F.regexp_replace(value, r'(\{"row_number":\d*7,"batch_id":"\d+"),"channel":"[^"]+"', "$1")
        return F.regexp_replace(value, r'"captured_at":"[^"]*[02468]\.', r'"captured_at":"never ')

    chat = raw.chat_envelopes(_base(spark, d)).select(harm("value").alias("value"))
    other = raw.emote_envelopes(_part(spark, d)).select(
        F.replace("value", F.lit('"emote_catalog"'), F.lit('"weather"')).alias("value")
    )
    cut = other.select(F.substring("value", 1, 60).alias("value"))
    rows = envelopes.explode_envelope(chat.unionByName(other).unionByName(cut))
    return envelopes.quarantine(rows).groupBy("stream", "reason").agg(F.count(F.lit(1)).alias("row_count"))


def append_dedup(spark, d):
    chat = tables.live_chat(_base(spark, d)).select("batch_id", "row_number", "channel", "message_text")
    sent_twice = chat.unionByName(chat)
    return stores.append_dedup(chat.where("row_number % 2 = 0"), sent_twice, S)


def staging_merge(spark, d):
    return stores.rows_merged(append_dedup(spark, d))


def upsert_latest(spark, d):
    catalog = tables.emote_catalog(_part(spark, d))
    early = F.unix_micros("fetched_at") % 2000000 == 0
    target = catalog.where(early).dropDuplicates(["service", "scope", "channel", "emote_id"])
    return stores.upsert_latest(target, catalog, ["service", "scope", "channel", "emote_id"], "fetched_at")


def write_rolling_parquet(spark, d):
    path = scratch_dir(configure(spark), "rolling")
    chat = tables.live_chat(_base(spark, d)).select("id", "channel", "message_text")
    stores.write_rolling_parquet(chat, path, 1000)
    return spark.read.schema(chat.schema).parquet(path)


def scan_bronze(spark, d):
    """Half of the files were written before the emotes column existed."""
    root = scratch_dir(configure(spark), "bronze")
    chat = tables.live_chat(_base(spark, d))
    chat.where("id % 2 = 0").drop("emotes").write.parquet(f"{root}/live_chat")
    chat.where("id % 2 = 1").write.mode("append").parquet(f"{root}/live_chat")
    return stores.scan_bronze(spark, root, "live_chat").select("id", "channel", "badges", "emotes")


# Quality ---------------------------------------------------------------------------


def dq_unique(spark, d):
    return quality.unique_combination(tables.models(spark, d).stg_chat, ["chatter_id"])


def dq_unique_combination(spark, d):
    return quality.unique_combination(tables.models(spark, d).stg_chat, ["chatter_id", "channel", "user_type"])


def dq_not_null(spark, d):
    return quality.not_null(tables.models(spark, d).stg_chat, "chatter_id").select("id", "channel")


def dq_accepted_values(spark, d):
    return quality.accepted_values(tables.models(spark, d).chatter_profile, "chatter_profile", ["sedentaire", "nomade"])


def dq_between(spark, d):
    moves = tables.models(spark, d).donation_deltas
    return quality.between(moves, "donation_delta_eur", low=0, severity="warn").select(
        "twitch_login", "ingested_at", "snapshot_id", "donation_delta_eur", "severity"
    )


def dq_exclude_synthetic(spark, d):
    return stores.without_synthetic(tables.models(spark, d).stg_chat, prefix="ch1").select("id", "channel")


def quality_report(spark, d):
    """All rules, over models that are written once."""
    models = tables.models(spark, d).measured(scratch_dir(spark, "key-stats"))
    quality.stage(models, scratch_dir(spark, "models"))
    return quality.report(models)


def source_freshness(spark, d):
    as_of = F.lit("2024-01-03 12:20:00").cast("timestamp")
    return quality.freshness(tables.models(spark, d).stg_chat, "ingested_at", S, as_of)


def gap_detection(spark, d):
    return quality.gaps(tables.models(spark, d).stg_chat, "message_sent_at", 900, S, "channel")


def gap_detection_overall(spark, d):
    return quality.gaps(tables.models(spark, d).stg_chat, "message_sent_at", 60, S)


# Streams ---------------------------------------------------------------------------


def _chat_stream(spark, d, batches=1):
    return tables.live_chat(raw.events_stream(configure(spark), d, batches))


def _snapshot_stream(spark, d, batches=1):
    return tables.event_snapshots(raw.events_stream(configure(spark), d, batches))


def _followed(spark, stream, job):
    root = scratch_dir(spark, "previous")
    previous.start(stream, job, root, S).awaitTermination()
    return previous.read(stream, job, root, S)


def stream_dedup(spark, d):
    chat = _chat_stream(spark, d).select("batch_id", "row_number", "channel", "captured_at")
    return drain(spark, windows.dedup(chat.unionByName(chat)))


def stream_hourly_chat(spark, d):
    parts = windows.hourly_chat_parts(_chat_stream(spark, d))
    return windows.hourly_chat(drain(spark, parts, windows.HOUR_KEYS))


def stream_quarter_hour(spark, d):
    parts = windows.quarter_hour_parts(_chat_stream(spark, d))
    return windows.quarter_hours(drain(spark, parts, windows.QUARTER_KEYS))


def chat_running_counts(spark, d):
    return drain(spark, windows.running_counts(_chat_stream(spark, d)), ["channel", "chatter"])


def channel_running_counts(spark, d):
    return drain(spark, windows.channel_running_counts(_chat_stream(spark, d)), ["channel"])


def stream_late_rows(spark, d):
    """Hours of a stream that gets a tenth of its first hours with its last: they are too late and do not count."""
    root = scratch_dir(configure(spark), "late")
    parts = windows.hourly_chat_parts(tables.live_chat(raw.inbox_stream(spark, d, f"{root}/inbox")))
    seen = []
    for rows in raw.in_turn(spark, d, 4, "k % 10 = 0"):
        rows.write.mode("append").parquet(f"{root}/inbox")
        seen = drained(spark, parts, root, windows.HOUR_KEYS)
    return windows.hourly_chat(seen)


def stream_stall_alert(spark, d):
    """Eight deliveries; the polls of the event are the heartbeat that goes on while a channel is silent."""
    root = scratch_dir(configure(spark), "alerts")
    base = raw.inbox_stream(spark, d, f"{root}/inbox")
    beats = base.where(tables.SNAPSHOT_FILTER).select(F.timestamp_micros("us").alias("at"))
    deliver(raw.in_turn(spark, d, 8), f"{root}/inbox", lambda: alerts.start(tables.live_chat(base), beats, root, 5, every=None))
    return alerts.alerts(spark, root).read()


def stream_rolling_parquet(spark, d):
    """Per channel the rows in files of at most 500, and whether any file has more."""
    root = scratch_dir(configure(spark), "rolling")
    stream = _chat_stream(spark, d, 4).select("id", "channel", "message_text")
    rolling.start(stream, f"{root}/files", f"{root}/checkpoint", rows_per_file=500, every=None).awaitTermination()
    written = rolling.table(stream, f"{root}/files", rows_per_file=500).read().withColumn("file", F.input_file_name())
    longest = written.groupBy("file").count().agg((F.max("count") <= 500).alias("files_within_limit")).select("files_within_limit").scalar()
    return written.groupBy("channel").agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct("id").alias("id_count")).withColumn("files_within_limit", longest)


def _ingested(spark, d, sent: list[DataFrame], files: int = 16) -> str:
    """Envelopes, each sent twice, through the whole ingest in several micro-batches; the root of the tables.

    Envelopes are made once; what is sent again is the text of the first time, file by file. The files are compressed:
    as plain text they are a hundred times the events they are made of."""
    root = scratch_dir(configure(spark), "ingest")
    inbox = f"{root}/inbox"
    for kind, envelopes_ in enumerate(sent):
        _send(envelopes_, f"{inbox}/0-{kind}")
        release_shuffles(spark)
    for kind in range(len(sent)):
        before = spark.conf.get("spark.sql.files.minPartitionNum", None)
        spark.conf.set("spark.sql.files.minPartitionNum", max(1, len(names(spark, f"{inbox}/0-{kind}"))))
        try:
            _send(spark.read.text(f"{inbox}/0-{kind}"), f"{inbox}/1-{kind}")
        finally:
            spark.conf.unset("spark.sql.files.minPartitionNum") if before is None else spark.conf.set("spark.sql.files.minPartitionNum", before)
    stream = spark.readStream.option("maxFilesPerTrigger", files).option("recursiveFileLookup", "true").text(inbox)
    ingest.start(stream, f"{root}/bronze", f"{root}/checkpoint", S, every=None).awaitTermination()
    return f"{root}/bronze"


def _send(envelopes_: DataFrame, folder: str) -> None:
    envelopes_.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(folder)


def ingested_chat(spark, d):
    """What the ingest stores of chat: typed values, and the time the envelope was sent."""
    root = _ingested(spark, d, [raw.chat_envelopes(_base(spark, d))])
    return stores.scan_bronze(spark, root, "live_chat").drop("id")


def ingested_streamer_profile(spark, d):
    """The profile of every streamer from envelopes that went through the ingest."""
    b = _base(spark, d)
    root = _ingested(spark, d, [raw.chat_envelopes(b), raw.metadata_envelopes(b), raw.snapshot_envelopes(b)])
    stored = {name: stores.scan_bronze(spark, root, name) for name in ("live_chat", "metadata_snapshots", "event_snapshots")}
    return Models(stored, S).streamer_profile


def stream_donation_deltas(spark, d):
    return _followed(spark, staging.snapshots(_snapshot_stream(spark, d, 8)), previous.DONATION_DELTAS)


def stream_mode_changes(spark, d):
    with_streamers = _snapshot_stream(spark, d, 8).where(F.size("streamers") > 0)
    return _followed(spark, with_streamers, previous.MODE_CHANGES)


def stream_channel_hops(spark, d):
    return _followed(spark, _chat_stream(spark, d, 8), previous.CHANNEL_HOPS)


def stream_ingest(spark, d):
    """Chat and catalog envelopes, each sent twice, through the whole ingest."""
    root = _ingested(spark, d, [raw.chat_envelopes(_base(spark, d)), raw.emote_envelopes(_part(spark, d))], 64)
    chat = ingest.stored(spark, root, "live_chat").select(
        F.lit("live_chat").alias("table"), F.concat_ws("/", "batch_id", "row_number").alias("identity"), "channel"
    )
    emotes = ingest.current(spark, root, "emote_catalog").select(
        F.lit("emote_catalog").alias("table"),
        F.concat_ws("/", "service", "scope", "emote_id", "emote_code").alias("identity"), "channel",
    )
    return chat.unionByName(emotes)


QUERIES = {
    f.__name__: f
    for f in [
        parse_chat_lines, parse_badges, parse_emotes, build_chat_rows, enrich_accounts, pending_accounts,
        parse_event_snapshot, latest_event, build_goal_rows, parse_emote_catalogs, flatten_emote_sets,
        merge_channel_emote_lists, emote_catalog_counts, build_metadata_snapshots, poll_summary, stream_end_events,
        roster_additions, recover_replay_chat, recover_replay_files, explode_envelope, typed_chat_rows, route_by_stream, quarantine,
        append_dedup, staging_merge, upsert_latest, write_rolling_parquet, scan_bronze, dq_unique,
        dq_unique_combination, dq_not_null, dq_accepted_values, dq_between, dq_exclude_synthetic, quality_report, source_freshness,
        gap_detection, gap_detection_overall, stream_dedup, stream_hourly_chat, stream_quarter_hour,
        chat_running_counts, channel_running_counts, stream_stall_alert, stream_donation_deltas, stream_mode_changes, stream_channel_hops,
        stream_ingest, stream_late_rows, stream_rolling_parquet, ingested_chat, ingested_streamer_profile,
    ]
}
QUERIES["dq_freshness"] = source_freshness
