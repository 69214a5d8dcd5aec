"""Raw inputs - chat lines, API documents, envelopes, replay documents - derived from the
driver's tables, so the ingest operators can be run and checked on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamtally.session import scratch_dir
from workload import tables

FILES_PER_BATCH = 16


def chat_lines(b: DataFrame) -> DataFrame:
    """Lines as received, every ninth without tags; some with line terminators inside, and between them
    lines of another kind."""
    wire = tables.project(
        b,
        {
            **tables.CHAT, "badges_tag": tables.BADGES_TAG, "emotes_tag": tables.EMOTES_TAG,
            "k": "k", "sent_ms": "us div 1000",
        },
    )
    optional = [("badges", "badges_tag"), ("emotes", "emotes_tag"), ("user-id", "chatter_id")]
    tags = F.concat(
        F.lit("@tmi-sent-ts="), F.col("sent_ms").cast("string"),
        *[F.coalesce(F.concat(F.lit(f";{tag}="), c), F.lit("")) for tag, c in optional],
        F.lit(";user-type="), F.col("user_type"),
        F.lit(";display-name="), F.when(F.col("k") % 5 == 0, "").otherwise(F.col("chatter")),
        F.lit(" "),
    )
    sender = F.concat(F.lit(":nick"), F.col("id").cast("string"), F.lit("!n@n.example PRIVMSG #"), F.col("channel"))
    inner = F.when(F.col("k") % 17 == 3, F.lit("\u2028tail\rx\u0085y")).otherwise("")
    message = F.concat(sender, F.lit(" :"), F.coalesce("message_text", F.lit("")), inner)
    line = F.when(F.col("k") % 9 == 0, message).otherwise(F.concat(tags, message))
    ended = F.when(F.col("k") % 4 == 0, F.concat(line, F.lit("\r\n"))).otherwise(line)
    other = F.when(F.col("k") % 13 == 0, F.array(ended, F.lit("PING :example"))).otherwise(F.array(ended))
    return wire.select("id", "captured_at", F.explode(other).alias("value"))


def roster(b: DataFrame) -> DataFrame:
    """Channels with an even number, as spelled by the platform."""
    named = b.select("channel").distinct()
    even = F.substring("channel", 3, 9).cast("int") % 2 == 0
    return named.where(even).select(F.upper("channel").alias("channel"))


def accounts(b: DataFrame) -> DataFrame:
    """Account facts of two chatters in three, resolved an hour after the first message."""
    wire = tables.chat_wire(b)
    return (
        wire.where(F.col("chatter_id").isNotNull() & (F.col("chatter_id").cast("bigint") % 3 != 0))
        .groupBy("chatter_id")
        .agg(
            F.max("account_created_at").alias("account_created_at"),
            F.max("broadcaster_type").alias("broadcaster_type"),
            (F.min("captured_at") + F.expr("interval 1 hour")).alias("resolved_at"),
        )
    )


def event_documents(b: DataFrame) -> DataFrame:
    def number(column):
        return F.struct(column.alias("number"))

    snapshots = tables.event_snapshots(b)
    live = F.transform(
        "streamers",
        lambda s: F.struct(
            s["twitch_id"].alias("twitch_id"), s["twitch_login"].alias("twitch"), s["display_name"].alias("display"),
            s["profile_url"].alias("profileUrl"), s["online"].alias("online"), s["game"].alias("game"),
            number(s["viewer_count"]).alias("viewersAmount"), number(s["donation_amount_eur"]).alias("donationAmount"),
        ),
    )
    body = F.to_json(
        F.struct(
            F.col("website_mode").alias("websiteMode"),
            number(F.col("total_donation_amount_eur")).alias("donationAmount"),
            number(F.col("total_viewer_count")).alias("viewersCount"),
            live.alias("live"),
        )
    )
    return snapshots.select("id", "batch_id", "row_number", "ingested_at", body.alias("body"))


def events_list(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.when(F.col("o_orderstatus") == "F", "Marathon ").otherwise("Other "), F.col("o_orderpriority")).alias("name"),
        F.struct(F.col("o_orderdate").cast("string").alias("start"), F.lit(None).cast("string").alias("end")).alias("schedule"),
    )


def participations(supplier: DataFrame) -> DataFrame:
    key = F.col("s_suppkey")
    twitch = F.struct(F.concat(F.lit("t"), key).alias("id"), F.lower("s_name").alias("login"))
    socials = F.struct(F.when(key % 5 != 0, twitch).alias("twitch"))
    return supplier.select(
        F.concat(F.lit("p"), key).alias("id"), F.col("s_name").alias("name"),
        (key % 4).alias("donation_goals_count"), socials.alias("socials"),
    )


def goals(part: DataFrame) -> DataFrame:
    return part.select(
        F.concat(F.lit("p"), F.col("p_partkey") % 100).alias("participation_id"),
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"),
        F.round(F.col("p_retailprice") * 100).cast("bigint").alias("amount"), F.col("p_brand").alias("category"),
        (F.col("p_size") > 25).alias("accomplished"),
    )


def emote_responses(part: DataFrame) -> DataFrame:
    """API responses of at most a hundred emotes, in the shape of their service; one in
    twenty came a second time, cut off."""
    catalog = tables.project(part, {**tables.EMOTES, "page": "p_partkey div 100", "key": "p_partkey", "size": "p_size"})
    named = F.struct(F.col("emote_id").alias("id"), F.col("emote_code").alias("name"))
    coded = F.struct(F.col("emote_id").alias("id"), F.col("emote_code").alias("code"))
    pages = catalog.groupBy("service", "scope", "channel", "page").agg(
        F.max("fetched_at").alias("fetched_at"),
        F.collect_list(named).alias("named"),
        F.collect_list(F.when(F.col("size") % 2 == 0, coded)).alias("even"),
        F.collect_list(F.when(F.col("size") % 2 == 1, coded)).alias("odd"),
        F.collect_list(coded).alias("coded"),
    )
    service, whole = F.col("service"), F.col("scope") == "global"
    sets = F.map_from_arrays(
        F.array(F.lit("3"), F.lit("4")), F.array(F.struct(F.col("named").alias("emoticons")), F.struct(F.slice("named", 1, 0).alias("emoticons")))
    )
    body = (
        F.when(service == "twitch", F.to_json(F.struct(F.col("named").alias("data"))))
        .when((service == "7tv") & whole, F.to_json(F.struct(F.col("named").alias("emotes"))))
        .when(service == "7tv", F.to_json(F.struct(F.struct(F.col("named").alias("emotes")).alias("emote_set"))))
        .when((service == "bttv") & whole, F.to_json("coded"))
        .when(service == "bttv", F.to_json(F.struct(F.col("even").alias("channelEmotes"), F.col("odd").alias("sharedEmotes"))))
        .when(whole, F.to_json(F.struct(F.array(F.lit("3"), F.lit("9")).alias("default_sets"), sets.alias("sets"))))
        .otherwise(F.to_json(F.struct(sets.alias("sets"))))
    )
    came = F.when(F.col("page") % 20 == 7, F.array(body, F.substring(body, 1, 12))).otherwise(F.array(body))
    return pages.select("service", "scope", "channel", "fetched_at", F.explode(came).alias("body"))


def live_streams(b: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Polls (one per snapshot), the roster, and the streams each poll found live."""
    polls = b.where(tables.SNAPSHOT_FILTER).select(
        F.col("event_id").alias("poll_id"), F.timestamp_micros("us").alias("snapshot_at"), "k", "us"
    )
    found = (
        polls.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(tables.CHANNELS - 1))))
        .where("(k + c) % 5 <> 0")
        .selectExpr(
            "poll_id", "concat('CH', c) as login",
            "case when (k + c) % 7 = 0 then null else concat('title', k % 3) end as title",
            "concat('game', (k + c) % 4) as category", "cast((k * 7 + c * 13) % 500 as int) as viewer_count",
            "timestamp_micros((us div 14400000000) * 14400000000) as stream_started_at",
        )
    )
    watched = b.select("channel").distinct().select("channel", F.concat(F.lit("b"), "channel").alias("broadcaster_id"))
    return polls.select("poll_id", "snapshot_at"), watched, found


def chat_envelopes(b: DataFrame) -> DataFrame:
    """One envelope per thousand messages."""
    payload = F.to_json(
        F.struct(
            "row_number", "batch_id", "channel", "chatter", "chatter_id", "message_text", "message_sent_at", "captured_at",
            F.to_json("badges").alias("badges"), F.to_json("emotes").alias("emotes"), "user_type", "account_created_at",
            "broadcaster_type",
        ),
        {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"},
    )
    return _envelopes(tables.live_chat(b).select("batch_id", "row_number", "captured_at", payload.alias("payload")), "live_chat", "captured_at")


def metadata_envelopes(b: DataFrame) -> DataFrame:
    """Channel polls, a thousand at most in an envelope."""
    return _envelopes(_sent(tables.metadata_snapshots(b), "snapshot_at"), "metadata", "snapshot_at")


def snapshot_envelopes(b: DataFrame) -> DataFrame:
    """One event snapshot per envelope, sent when it was taken."""
    polls = tables.event_snapshots(b).where(F.size("streamers") > 0)
    single = polls.withColumns({"streamers": F.to_json("streamers"), "batch_id": F.lpad(F.col("id").cast("string"), 12, "0"), "row_number": F.lit(0)})
    return _envelopes(_sent(single, "ingested_at"), "event_snapshot", "ingested_at")


def _sent(rows: DataFrame, clock: str) -> DataFrame:
    fields = [c for c in rows.columns if c not in ("id", "ingested_at")]
    payload = F.to_json(F.struct(*fields), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    return rows.select("batch_id", "row_number", clock, payload.alias("payload"))


def emote_envelopes(part: DataFrame) -> DataFrame:
    """Catalog rows; a key turns up several times."""
    rows = tables.emote_catalog(part).withColumn("row_number", (F.unix_micros("fetched_at") % 1000).cast("int"))
    keyed = rows.withColumn("batch_id", (F.unix_micros("fetched_at").__sub__(F.lit(tables.T0)) / F.lit(1e9)).cast("int").cast("string"))
    payload = F.to_json(
        F.struct("service", "scope", "channel", "emote_id", "emote_code", "fetched_at"),
        {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"},
    )
    return _envelopes(keyed.select(F.concat(F.lit("e"), "batch_id").alias("batch_id"), F.unix_micros("fetched_at").alias("row_number"), "fetched_at", payload.alias("payload")), "emote_catalog", "fetched_at")


def _envelopes(rows: DataFrame, stream: str, clock: str) -> DataFrame:
    """Envelopes that were sent with their last row."""
    listed = F.array_join(F.sort_array(F.collect_list(F.struct("row_number", "payload")))["payload"], ",")
    sent_at = F.date_format(F.max(clock), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return rows.groupBy("batch_id").agg(listed.alias("_rows"), sent_at.alias("_sent")).select(
        F.concat(
            F.lit(f'{{"source":"test","stream":"{stream}","batch_id":"'), "batch_id",
            F.lit('","batched_at":"'), "_sent", F.lit('","rows":['), "_rows", F.lit("]}"),
        ).alias("value")
    )


def replay_documents(conversations: DataFrame) -> DataFrame:
    """A conversation as a replay of one broadcast; words of five letters are emotes."""
    words = F.split("text", " ")
    fragment = F.transform(
        words,
        lambda w: F.struct(
            w.alias("text"), F.when(F.length(w) == 5, F.struct(F.lower(w).alias("emoticon_id"))).alias("emoticon")
        ),
    )
    at = F.timestamp_micros(F.lit(tables.T0) + (F.col("conv_id") * 100 + F.col("turn")) * 1000000)
    comment = F.struct(
        F.col("turn").alias("_turn"),
        F.concat_ws("-", "conv_id", "turn").alias("_id"), at.alias("created_at"),
        F.col("conv_id").cast("string").alias("channel_id"), F.col("turn").alias("content_offset_seconds"),
        F.struct(
            F.col("role").alias("display_name"), F.concat(F.lit("id_"), "role").alias("_id"), F.col("role").alias("name"),
            F.timestamp_micros(F.lit(tables.T0) - F.col("conv_id") * 1000000).alias("created_at"),
        ).alias("commenter"),
        F.struct(
            F.col("text").alias("body"), fragment.alias("fragments"),
            F.array(F.struct(F.lit("vip").alias("_id"), F.col("turn").cast("string").alias("version"))).alias("user_badges"),
        ).alias("message"),
    )
    return (
        conversations.groupBy("conv_id", F.expr("turn div 100").alias("_part"))
        .agg(F.array_sort(F.collect_list(comment)).alias("comments"))
        .select(
            F.struct(F.lit("S").alias("name"), F.concat(F.lit("ch"), F.col("conv_id") % 12).alias("login"), "conv_id").alias("streamer"),
            F.struct(F.concat_ws("-", "conv_id", "_part").alias("id")).alias("video"),
            "comments",
        )
    )


def in_turn(spark: SparkSession, sf_dir: str, turns: int, late: str = "false") -> list[DataFrame]:
    """The events cut into `turns` equal spans of time; rows of the first span for which `late` holds come with the last."""
    events, base = tables.read(spark, sf_dir, "events"), tables.BASE
    turn = f"least(({base['us']} - {tables.T0}) $DIV {216_000_000_000 // turns}, {turns - 1})"
    k = tables.spark_expr(base["k"])
    dealt = events.withColumn("_turn", F.expr(tables.spark_expr(turn))).withColumn("k", F.expr(k))
    dealt = dealt.withColumn("_turn", F.when((F.col("_turn") == 0) & F.expr(late), turns - 1).otherwise(F.col("_turn")))
    return [dealt.where(F.col("_turn") == t).select(events.columns) for t in range(turns)]


def inbox_stream(spark: SparkSession, sf_dir: str, inbox: str) -> DataFrame:
    """The events that are laid into a folder, squeezed like `tables.base`."""
    events = tables.read(spark, sf_dir, "events")
    events.where("false").write.parquet(inbox)
    return tables.base_of(spark.readStream.schema(events.schema).parquet(inbox))


def events_stream(spark: SparkSession, sf_dir: str, batches: int = 1) -> DataFrame:
    """The events table as a stream, squeezed like `tables.base`; in several micro-batches, rows come in no order.

    A micro-batch has FILES_PER_BATCH files: one that is smaller than a split would be read by a single task."""
    events = tables.read(spark, sf_dir, "events")
    reader = spark.readStream.schema(events.schema)
    if batches == 1:
        return tables.base_of(reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir))
    path = scratch_dir(spark, "events")
    events.repartition(batches * FILES_PER_BATCH, F.xxhash64("event_id")).write.parquet(path)
    return tables.base_of(reader.option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(path))
