"""Chat lines of the IRC-style wire format, and their rows.

All functions work on batch and streaming DataFrames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Fixed pattern of a message line: optional tags, sender, channel, text. `(?d)`: only a line feed
# ends a line, so no part holds one; the other terminators of Unicode and a lone carriage return are text.
MESSAGE_LINE = r"(?d)^(?:@(\S+) )?:([^!\n]+)!\S+ PRIVMSG #(\S+) :(.*)$"


def pairs_of(raw: str | Column, between: str, within: str) -> Column:
    """Map of `key<within>value` entries; entries without `within` are dropped, later ones win."""
    text = F.col(raw) if isinstance(raw, str) else raw
    split = F.str_to_map(F.coalesce(text, F.lit("")), F.lit(between), F.lit(within))
    return F.map_filter(split, lambda k, v: v.isNotNull())


def badges_of(raw: str | Column) -> Column:
    """`moderator/1,subscriber/12` as a map; absent or empty gives an empty map."""
    return pairs_of(raw, ",", "/")


def emotes_of(raw: str | Column) -> Column:
    """`25:0-4,12-16/1902:6-10` as emote id -> number of positions."""
    text = F.col(raw) if isinstance(raw, str) else raw
    entries = F.split(F.coalesce(text, F.lit("")), "/")

    def counted(entry: Column) -> Column:
        positions = F.filter(F.split(F.substring_index(entry, ":", -1), ","), lambda p: p != "")
        return F.struct(
            F.substring_index(entry, ":", 1).alias("id"),
            F.when(entry.contains(":"), F.size(positions)).otherwise(F.lit(0)).alias("uses"),
        )

    return F.map_from_entries(F.filter(F.transform(entries, counted), lambda e: e["uses"] > 0))


def parse_chat_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row per message line with `tags` (map), `nick`, `channel`, `text`; other lines
    are dropped. Line ends around a line are no part of it. All other input columns are kept."""
    kept = [c for c in lines.columns if c != column]
    line = F.btrim(F.col(column), F.lit("\r\n"))
    # All four groups in one pass of the pattern, joined by line feeds, which none of them can hold.
    groups = F.split(F.regexp_replace(line, MESSAGE_LINE, "$1\n$2\n$3\n$4"), "\n", 4)
    parts = lines.where(line.rlike(MESSAGE_LINE)).select(*kept, groups.alias("_g"))
    tags = F.col("_g")[0]
    return parts.select(
        *kept,
        F.col("_g")[1].alias("nick"),
        F.col("_g")[2].alias("channel"),
        F.col("_g")[3].alias("text"),
        F.when(tags != "", pairs_of(tags, ";", "=")).alias("tags"),
    )


def build_chat_rows(parsed: DataFrame, roster: DataFrame, captured_at: str) -> DataFrame:
    """Typed chat rows of the channels in `roster` (column `channel`); account facts come
    later, from `enrich_accounts`. A message without its own time takes the capture time."""

    def tag(name: str) -> Column:
        return F.element_at("tags", name)

    sent_ms = tag("tmi-sent-ts").try_cast("bigint")
    known = roster.select(F.lower("channel").alias("_login"), F.col("channel").alias("_spelled"))
    kept = [c for c in parsed.columns if c not in ("nick", "channel", "text", "tags", captured_at)]
    return (
        parsed.join(known, F.lower("channel") == F.col("_login"))
        .select(
            *kept,
            F.col("_spelled").alias("channel"),
            F.coalesce(F.nullif(tag("display-name"), F.lit("")), F.col("nick")).alias("chatter"),
            tag("user-id").alias("chatter_id"),
            F.col("text").alias("message_text"),
            F.coalesce(F.timestamp_millis(sent_ms), F.col(captured_at)).alias("message_sent_at"),
            F.col(captured_at).alias("captured_at"),
            badges_of(tag("badges")).alias("badges"),
            tag("user-type").alias("user_type"),
            emotes_of(tag("emotes")).alias("emotes"),
        )
    )


def enrich_accounts(rows: DataFrame, accounts: DataFrame) -> DataFrame:
    """Adds account facts known when the message was captured. `accounts` is unique on
    chatter_id: account_created_at, broadcaster_type, resolved_at. Messages captured
    before their chatter was resolved stay null."""
    facts = accounts.select(
        F.col("chatter_id").alias("_id"), "account_created_at", "broadcaster_type", "resolved_at"
    )
    in_time = F.col("resolved_at") <= F.col("captured_at")
    # Messages without an id match nothing and would meet in one task: their keys are spread, and told from ids.
    lane = F.when(F.col("chatter_id").isNull(), F.xxhash64("channel", "message_text", "captured_at")).otherwise(F.lit(0))
    own = F.struct(lane.alias("lane"), F.coalesce("chatter_id", F.lit("")).alias("id"))
    wanted = F.struct(F.lit(0).cast("long").alias("lane"), F.coalesce("_id", F.lit("")).alias("id"))
    return rows.join(facts.where(F.col("_id").isNotNull()), own == wanted, "left").select(
        *rows.columns,
        F.when(in_time, F.col("account_created_at")).alias("account_created_at"),
        F.when(in_time, F.col("broadcaster_type")).alias("broadcaster_type"),
    )


def pending_accounts(rows: DataFrame, accounts: DataFrame) -> DataFrame:
    """Chatter ids seen in chat that have no account facts yet."""
    seen = rows.where(F.col("chatter_id").isNotNull()).select("chatter_id").distinct()
    return seen.join(accounts.select("chatter_id"), "chatter_id", "left_anti")

