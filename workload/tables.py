"""Domain tables derived from the driver's tables, for Spark and - with the same
expressions - for the SQL the results are checked against.

`events` becomes chat messages, metadata polls and event snapshots, `part` becomes
donation goals and the emote catalog. Every table is a projection, so it grows with
its source. The month of events is squeezed twelvefold into 60 hours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamtally import Models, Settings
from streamtally.schemas import BRONZE
from streamtally.session import configure

CHANNELS = 12
T0 = 1704067200000000  # 2024-01-01T00:00:00Z in microseconds

# name -> expression; $US, $TS(...), $DIV and $SEC(n) differ between the engines.
BASE = {
    "event_id": "event_id",
    "user_id": "user_id",
    "event_type": "event_type",
    "value": "value",
    "k": "cast(replace(replace(props, '{\"k\": ', ''), '}', '') as int)",
    "us": f"{T0} + ($US - {T0}) $DIV 12",
}
BASE_MORE = {
    "channel": f"concat('ch', cast((user_id + k % (1 + user_id % 15)) % {CHANNELS} as varchar(9)))",
    "batch_id": "cast(event_id $DIV 1000 as varchar(20))",
    "row_number": "cast(event_id % 1000 as int)",
}
CHAT = {
    "id": "event_id",
    "batch_id": "batch_id",
    "row_number": "row_number",
    "channel": "channel",
    "chatter": (
        "case when user_id % 11 = 0 then concat('CH', cast(user_id % 12 as varchar(9))) "
        "when user_id % 5 = 0 then concat('user', cast(10000 + user_id as varchar(9))) "
        "else concat('viewer_', cast(user_id as varchar(9))) end"
    ),
    "chatter_id": "case when k = 7 then null else cast(user_id as varchar(20)) end",
    "message_text": (
        "case k % 14 when 0 then 'merci bravo !!' when 1 then 'KEKW KEKW' when 2 then 'xconnard !' "
        "when 3 then 'CONNARDS' when 4 then 'super LUL' when 5 then concat('hello  E', cast(user_id % 40 as varchar(9))) "
        "when 6 then concat(' E', cast(k as varchar(9)), ' E1') when 7 then null when 8 then '' when 9 then '!!!!' "
        "when 10 then concat('E', cast(event_id % 97 as varchar(9)), ' E3 E3') when 11 then 'ta gueule' "
        "else event_type end"
    ),
    "message_sent_at": "case when k = 98 then null else $TS(us) end",
    "captured_at": "$TS(us + 1000000)",
    "account_created_at": "case when user_id % 9 = 0 then null else $TS(1704067200000000 - user_id * 864000000000) end",
    "broadcaster_type": "case user_id % 3 when 0 then 'partner' when 1 then '' else 'affiliate' end",
    "user_type": "case when k % 50 = 0 then 'staff' else '' end",
    "ingested_at": "$TS(us + 1000000)",
}
# Wire form of the two map columns: the platform's tag syntax.
BADGES_TAG = (
    "case k % 6 when 0 then 'subscriber/12' when 1 then 'moderator/1,subscriber/3' when 2 then 'vip/1' "
    "when 3 then null else '' end"
)
EMOTES_TAG = (
    "case k % 4 when 0 then '25:0-4,6-10/1902:12-16' when 1 then '' when 2 then null else '354:0-3' end"
)
METADATA = {
    "id": "event_id",
    "batch_id": "batch_id",
    "row_number": "row_number",
    "channel": "channel",
    "broadcaster_id": "concat('b', channel)",
    "is_live": "event_type <> 'error'",
    "title": "case when k % 40 = 39 then null else concat('title', cast((us $DIV 14400000000) % 3 as varchar(9))) end",
    "category": "case when k % 25 = 0 then null else concat('game', cast((us $DIV 28800000000) % 4 as varchar(9))) end",
    "viewer_count": "case when event_type = 'error' then null else cast(floor(value * 10) as int) end",
    "duration_seconds": (
        "case when event_type = 'error' then null else cast(us % 28800000000 as double) / 500000 end"
    ),
    "stream_started_at": "$TS((us $DIV 28800000000) * 28800000000)",
    "snapshot_at": "$TS(us)",
    "ingested_at": "$TS(us)",
}
METADATA_FILTER = "event_type in ('view', 'signup', 'error')"
SNAPSHOT = {
    "id": "event_id",
    "batch_id": "batch_id",
    "row_number": "row_number",
    "website_mode": (
        "case when k = 99 then null when k % 10 = 0 then 'pause' "
        f"when (us - {T0}) $DIV 72000000000 = 0 then 'pre' else 'live' end"
    ),
    "total_donation_amount_eur": f"cast(((us - {T0}) $DIV 60000000) * 546 + k % 5 as double) / 100",
    "total_viewer_count": "k * 100",
    "ingested_at": "$TS(us)",
}
SNAPSHOT_FILTER = "event_type = 'purchase'"
# One streamer `c` of a snapshot; the amount is in cents.
STREAMER_FIELDS = {
    "twitch_id": "concat('t', cast(c as varchar(9)))",
    "twitch_login": (
        "case when c = 11 and k % 33 = 0 then null when c = 3 then 'CH3' else concat('ch', cast(c as varchar(9))) end"
    ),
    "display_name": "concat('Name_', cast(c as varchar(9)))",
    "profile_url": "concat('/p/', cast(c as varchar(9)))",
    "online": "case when k % 37 = 0 and c = 2 then null else (k + c) % 5 <> 0 end",
    "game": "concat('game', cast((k + c) % 4 as varchar(9)))",
    "viewer_count": "cast((k * 7 + c * 13) % 500 as int)",
    "amount_cents": (
        f"case when k % 41 = 0 and c = 5 then null else ((us - {T0}) $DIV 60000000) * (c + 1) * 7 "
        "+ ((k * (c + 3)) % 7) * 100 end"
    ),
}
GOALS = {
    "participation_id": "concat('p', cast(p_partkey % 12 as varchar(9)))",
    "streamer_name": "concat('Name_', cast(p_partkey % 12 as varchar(9)))",
    "twitch_login": "case when p_size = 7 then null else concat('CH', cast(p_partkey % 12 as varchar(9))) end",
    "twitch_id": "case when p_size = 7 then null else concat('t', cast(p_partkey % 12 as varchar(9))) end",
    "goal_id": "cast(p_partkey as varchar(20))",
    "goal_name": "p_name",
    "goal_amount_eur": "cast(p_retailprice as decimal(12,2))",
    "goal_category": "case when p_size % 10 = 0 then null else p_brand end",
    "snapshot_at": f"$TS({T0} + p_partkey * 1000000)",
    "ingested_at": f"$TS({T0} + p_partkey * 1000000)",
}
EMOTES = {
    "service": "case p_partkey % 4 when 0 then 'twitch' when 1 then '7tv' when 2 then 'bttv' else 'ffz' end",
    "scope": "case when p_size % 10 = 0 then 'global' else 'channel' end",
    "channel": (
        "case when p_size % 10 = 0 then '__global__' else concat('ch', cast((p_partkey $DIV 4) % 12 as varchar(9))) end"
    ),
    "emote_id": "case p_partkey % 12 when 0 then '25' when 4 then '354' else cast(p_partkey as varchar(20)) end",
    "emote_code": "concat('E', cast((p_partkey $DIV 4) % 120 as varchar(9)))",
    "fetched_at": f"$TS({T0} + p_partkey * 1000000)",
    "ingested_at": f"$TS({T0} + p_partkey * 1000000)",
}


def spark_expr(text: str) -> str:
    return (
        text.replace("$US", "unix_micros(cast(ts as timestamp))")
        .replace("$TS", "timestamp_micros")
        .replace("$DIV", "div")
    )


def project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{spark_expr(e)} as {name}" for name, e in columns.items()])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base_of(read(spark, sf_dir, "events"))


def base_of(events: DataFrame) -> DataFrame:
    squeezed = project(events, BASE)
    return squeezed.withColumns({name: F.expr(spark_expr(e)) for name, e in BASE_MORE.items()})


def chat_wire(b: DataFrame) -> DataFrame:
    """Chat messages with badges and emotes as platform tags."""
    return project(b, {**CHAT, "badges_tag": BADGES_TAG, "emotes_tag": EMOTES_TAG})


def live_chat(b: DataFrame) -> DataFrame:
    from streamtally.sources.chat_lines import badges_of, emotes_of

    return chat_wire(b).select(
        *CHAT,
        F.when(F.col("badges_tag").isNotNull(), badges_of("badges_tag")).alias("badges"),
        F.when(F.col("emotes_tag").isNotNull(), emotes_of("emotes_tag")).alias("emotes"),
    )


def metadata_snapshots(b: DataFrame) -> DataFrame:
    return project(b.where(METADATA_FILTER), METADATA)


def event_snapshots(b: DataFrame) -> DataFrame:
    """Event snapshots with their array of streamers; none at k = 13 (empty) and 14 (null)."""
    amount = STREAMER_FIELDS["amount_cents"]
    fields = {
        **{name: e for name, e in STREAMER_FIELDS.items() if name != "amount_cents"},
        "donation_amount_eur": f"cast(cast({amount} as decimal(18,0)) / 100 as decimal(18,2))",
    }
    streamer = ", ".join(f"{spark_expr(e)} as {name}" for name, e in fields.items())
    numbers = f"slice(sequence(0, {CHANNELS - 1}), 1, if(k = 13, 0, {CHANNELS}))"
    listed = f"case when k <> 14 then transform({numbers}, c -> struct({streamer})) end"
    return project(b.where(SNAPSHOT_FILTER), {**SNAPSHOT, "streamers": listed})


def donation_goals(part: DataFrame) -> DataFrame:
    return project(part, GOALS)


def emote_catalog(part: DataFrame) -> DataFrame:
    return project(part, EMOTES)


def bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    configure(spark)
    b, part = base(spark, sf_dir), read(spark, sf_dir, "part")
    tables = {
        "live_chat": live_chat(b),
        "metadata_snapshots": metadata_snapshots(b),
        "event_snapshots": event_snapshots(b),
        "donation_goals": donation_goals(part),
        "emote_catalog": emote_catalog(part),
    }
    assert set(tables) == set(BRONZE)
    return tables


def models(spark: SparkSession, sf_dir: str, settings: Settings = Settings()) -> Models:
    return Models(bronze(spark, sf_dir), settings)
