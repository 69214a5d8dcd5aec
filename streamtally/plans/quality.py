"""Data-quality rules as DataFrames of violations, and freshness."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamtally.functions.ratio import rows
from streamtally.functions.time import seconds_between
from streamtally.operators.ordered import micros, next_row, slice_hot_keys
from streamtally.schemas import PROFILES, SCOPES, SERVICES
from streamtally.session import release_shuffles
from streamtally.settings import Settings


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column values that occur on more than one row. A single column ignores nulls."""
    keyed = df.where(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    return keyed.groupBy(*columns).agg(rows().alias("row_count")).where(F.col("row_count") > 1)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the domain, with how often they occur."""
    strange = df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
    return strange.groupBy(column).agg(rows().alias("row_count"))


def between(
    df: DataFrame, column: str, low: float | None = None, high: float | None = None, severity: str = "error"
) -> DataFrame:
    outside: Column = F.lit(False)
    if low is not None:
        outside = outside | (F.col(column) < low)
    if high is not None:
        outside = outside | (F.col(column) > high)
    return df.where(outside).withColumn("severity", F.lit(severity))


def freshness(df: DataFrame, loaded_at: str, settings: Settings, as_of: Column | None = None) -> DataFrame:
    """Age of the newest row: pass, warn or error."""
    now = as_of if as_of is not None else F.lit(settings.as_of)
    age = seconds_between("newest", now) / F.lit(60.0)
    return (
        df.agg(F.max(loaded_at).alias("newest"))
        .withColumn("age_minutes", age)
        .withColumn(
            "status",
            F.when(F.col("newest").isNull() | (F.col("age_minutes") > settings.freshness_error_minutes), "error")
            .when(F.col("age_minutes") > settings.freshness_warn_minutes, "warn")
            .otherwise("pass"),
        )
    )


def gaps(df: DataFrame, ts: str, threshold_seconds: int, settings: Settings, key: str | None = None) -> DataFrame:
    """Spans longer than the threshold without any row, per `key` or over everything.

    Rows of one threshold-wide cell are never that far apart, so a gap lies between the last row of a
    cell and the first of the key's next one: rows are first reduced to one per (key, cell).
    """
    keys = [key] if key else []
    width = threshold_seconds * 1_000_000
    cell = F.floor(micros(ts) / F.lit(width)).alias("_cell")
    cells = df.where(F.col(ts).isNotNull()).groupBy(*keys, cell).agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    ordered = next_row(slice_hot_keys(cells, keys, F.col("_cell"), settings), keys, ["_cell"], ["_first"])
    length = seconds_between("_last", "next._first")
    return ordered.where(length > threshold_seconds).select(
        *keys,
        F.col("_last").alias("gap_started_at"),
        F.col("next._first").alias("gap_ended_at"),
        length.alias("gap_seconds"),
    )


@dataclass(frozen=True)
class Rule:
    model: str
    check: str
    columns: tuple[str, ...]
    values: tuple[str, ...] = ()
    severity: str = "error"
    bounds: tuple[float | None, float | None] = field(default=(None, None))

    def violations(self, df: DataFrame) -> DataFrame:
        if self.check == "unique":
            return unique_combination(df, self.columns)
        if self.check == "not_null":
            return not_null(df, self.columns[0])
        if self.check == "accepted_values":
            return accepted_values(df, self.columns[0], self.values)
        return between(df, self.columns[0], *self.bounds, self.severity)

    def entry(self, number: int, keys: Sequence[str]) -> Column:
        """What a row adds to the report: the rule's number and the values that are counted, in the fields of `keys`, or
        null. Uniqueness takes every row's values, the other checks only the values of violating rows."""
        c = F.col(self.columns[0])
        low, high = self.bounds
        if self.check == "unique":
            counts = c.isNotNull() if len(self.columns) == 1 else F.lit(True)
        elif self.check == "not_null":
            counts = c.isNull()
        elif self.check == "accepted_values":
            counts = c.isNotNull() & ~c.isin(list(self.values))
        else:
            counts = (c < low if low is not None else F.lit(False)) | (c > high if high is not None else F.lit(False))
        values = [F.when(F.lit(k in self.keys), F.col(k)).alias(f"key{i}") for i, k in enumerate(keys)]
        return F.struct(F.when(counts, F.lit(number)).alias("rule"), *values)

    @property
    def keys(self) -> tuple[str, ...]:
        return self.columns if self.check in ("unique", "accepted_values") else ()

    def violations_of(self, n: Column) -> Column:
        """The number of `violations` from the counts of the rule's values."""
        if self.check == "unique":
            return F.count_if(n > 1)
        return F.count(n) if self.check == "accepted_values" else F.sum(n)


def _unique(model: str, *columns: str) -> Rule:
    return Rule(model, "unique", columns)


def _present(model: str, *columns: str) -> list[Rule]:
    return [Rule(model, "not_null", (c,)) for c in columns]


def _key(model: str, column: str) -> list[Rule]:
    return [_unique(model, column), *_present(model, column)]


# Which columns of which model are keys, are required, or have a domain.
RULES: list[Rule] = [
    *_key("stg_chat", "id"),
    *_present("stg_chat", "channel"),
    _unique("stg_chat", "batch_id", "row_number"),
    *_key("stg_metadata", "id"),
    *_present("stg_metadata", "channel"),
    _unique("stg_metadata", "batch_id", "row_number"),
    *_present("stg_goals", "participation_id", "goal_id"),
    _unique("stg_goals", "participation_id", "goal_id"),
    *_present("stg_emotes", "service", "scope", "channel", "emote_code"),
    Rule("stg_emotes", "accepted_values", ("service",), tuple(SERVICES)),
    Rule("stg_emotes", "accepted_values", ("scope",), tuple(SCOPES)),
    _unique("stg_emotes", "service", "scope", "channel", "emote_id"),
    Rule("donation_deltas", "between", ("donation_delta_eur",), severity="warn", bounds=(0, None)),
    _unique("chat_hourly_activity", "channel", "hour_bucket"),
    _unique("chatter_channel_activity", "chatter_id", "channel"),
    _unique("hourly_edges", "chatter_id", "channel", "hour_bucket"),
    Rule("emote_usage", "accepted_values", ("service",), tuple(SERVICES)),
    _unique("stream_hourly_viewership", "channel", "hour_bucket"),
    _unique("stream_sessions", "channel", "stream_started_at"),
    *_key("chatter_activity", "chatter_id"),
    _unique("chatter_quarter_hour", "chatter_id", "quarter_hour_bucket"),
    _unique("channel_pair_jaccard", "channel_a", "channel_b"),
    _unique("stream_concurrency", "hour_bucket"),
    *_key("mode_changes", "snapshot_id"),
    _unique("emote_catalog_coverage", "channel", "service", "emote_id"),
    _unique("donation_hourly_last", "twitch_login", "hour_bucket"),
    _unique("donation_rank_hourly", "twitch_login", "hour_bucket"),
    _unique("title_segments", "channel", "segment_id"),
    _unique("chat_hourly_mood", "channel", "hour_bucket"),
    Rule("donation_timeseries", "between", ("donation_delta_eur",), severity="warn", bounds=(0, None)),
    *_present("goals_current", "participation_id", "goal_id"),
    _unique("goals_current", "participation_id", "goal_id"),
    _unique("engagement_vs_donations", "channel", "hour_bucket"),
    _unique("chatter_leaderboard", "chatter_id", "channel"),
    *_key("chatter_profile", "chatter_id"),
    Rule("chatter_profile", "accepted_values", ("chatter_profile",), tuple(PROFILES)),
    _unique("hourly_network", "hour_bucket", "channel_a", "channel_b"),
    *_key("event_daily_rollup", "day_bucket"),
    _unique("viewership_timeseries", "channel", "hour_bucket"),
    *_key("streamer_profile", "channel"),
    _unique("chatter_retention", "chatter_id", "quarter_hour_bucket"),
    _unique("new_chatters_per_channel", "channel", "day_bucket"),
    *_key("badge_and_verbosity", "channel"),
    *_key("breadth_depth_lifespan", "chatter_id"),
    *_key("bot_signal", "chatter_id"),
    *_key("donation_normalized", "twitch_login"),
    Rule("donation_spikes", "between", ("donation_delta_eur",), bounds=(0, None)),
    _unique("goals_by_category", "goal_category"),
    *_key("donation_reconciliation", "snapshot_id"),
    _unique("session_analysis", "channel", "stream_started_at"),
    *_key("downtime_patterns", "channel"),
    _unique("emote_catalog_utilization", "channel", "service"),
    _unique("support_network", "supporting_streamer_login", "supported_channel"),
    *_key("event_phase_totals", "event_phase"),
    *_key("retention_curve", "day_index"),
    *_key("chatter_enriched", "chatter_id"),
]


# What other models read, in an order in which no model reads one of its own or a later line.
SHARED = [
    ["stg_chat", "stg_metadata", "stg_snapshots", "stg_goals", "stg_emotes"],
    [
        "donation_deltas", "chatter_rollup", "chatter_regularity", "hourly_edges", "chatter_quarter_hour", "chatter_channel_activity",
        "chat_hourly_activity", "emote_catalog_coverage", "stream_hourly_viewership", "stream_sessions",
    ],
]


def stage(models, root: str, rules: Sequence[Rule] = RULES, at_once: int = 4) -> None:
    """Writes the models of the rules, each once. What several of them read is written before them, whether it has rules
    or not: otherwise each of them would work it out again."""
    read = [name for line in SHARED for name in line]
    own = [m for m in dict.fromkeys(r.model for r in rules) if m not in read]
    for line in [*SHARED, *(own[i : i + 12] for i in range(0, len(own), 12))]:
        models.materialize(line, root, at_once)
        release_shuffles(getattr(models, line[0]).sparkSession)


def report(models, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per rule with its number of violations.

    A model is read once for all its rules: every row is expanded to what it adds to each of them, and one
    aggregate counts rules and values together. Write the models first (`stage`) where they are
    derived from each other.
    """
    by_model: dict[str, list[tuple[int, Rule]]] = {}
    for number, rule in enumerate(rules):
        by_model.setdefault(rule.model, []).append((number, rule))

    found: DataFrame | None = None
    for model, own in by_model.items():
        # Values keep their types: a field of the entries is filled by the rules it is a key of.
        keys = list(dict.fromkeys(k for _, rule in own for k in rule.keys))
        entries = F.array(*[rule.entry(number, keys) for number, rule in own])
        expanded = getattr(models, model).select(F.inline(entries)).where(F.col("rule").isNotNull())
        counted = expanded.groupBy("rule", *[f"key{i}" for i in range(len(keys))]).agg(rows().alias("n"))
        each = [F.coalesce(rule.violations_of(F.when(F.col("rule") == number, F.col("n"))), F.lit(0)).alias(f"v{number}") for number, rule in own]
        listed = [
            F.struct(*[F.lit(v).alias(k) for k, v in _named(rule).items()], F.col(f"v{number}").cast("long").alias("violations"))
            for number, rule in own
        ]
        part = counted.agg(*each).select(F.inline(F.array(*listed)))
        found = part if found is None else found.unionByName(part)
    return found


def _named(rule: Rule) -> dict[str, str]:
    return {"model": rule.model, "check": rule.check, "columns": ",".join(rule.columns), "severity": rule.severity}
