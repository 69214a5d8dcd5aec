"""The previous row of a key on a stream: what `lag` is in batch.

Window functions are not available on streams, so each micro-batch is worked off as a batch. Three tables are kept
(`table_log`): the last row of each key, in buckets by key, of which a micro-batch opens and rewrites those of its
own keys; all rows, in parts with their time span; and the last row of each key and day.

Rows that come in order need the first table only, so what a micro-batch reads does not grow with the stream. Of a
key whose rows come late, the stored rows from the day of the earliest late row on are read, and the row before
that day is found among the last rows of the days. All of them go through `previous_row`, which cuts a hot key's
rows over many tasks: a late row finds its place, and the row after it is derived again. Of the stored rows only
those behind a new one are written again, so the results are at most twice the rows, in whatever order these came.
A repeated micro-batch starts from the tables before it; of a row derived more than once the last result counts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from streamtally.functions.time import seconds_between
from streamtally.operators.latest import latest_per_key
from streamtally.operators.ordered import SLICE, micros, order_key, previous_row, slice_hot_keys, uncut, whole
from streamtally.schemas import MONEY
from streamtally.settings import Settings
from streamtally.sources.table_log import Table, bucket_of

# Up to this many keys with late rows are sent to every task, so that only their stored rows are shuffled.
BROADCAST_KEYS = 100_000


@dataclass(frozen=True)
class Job:
    """`rows` makes the sequence's rows from the stream, `result` the output from rows with `prev`."""

    rows: Callable[[DataFrame], DataFrame]
    key: str
    order: tuple[str, str]  # time, then the tie breaker
    carry: tuple[str, ...]
    result: Callable[[DataFrame, Settings], DataFrame]


class Store:
    """The tables of one job under `root`, for rows of this schema."""

    def __init__(self, spark: SparkSession, root: str, job: Job, schema: StructType, settings: Settings):
        self.job, self.columns = job, schema.names
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        clock = job.order[0]
        self.rows = Table(spark, f"{root}/rows", ddl, clock)
        self.tails = Table(spark, f"{root}/tails", ddl, clock)
        self.bucket = bucket_of(job.key, settings.state_buckets)
        self.state = Table(spark, f"{root}/state", ddl, bucket=self.bucket)

    def latest(self, rows: DataFrame, *by: Column) -> DataFrame:
        """Each key's last row, or the last one per key and `by`."""
        job, names = self.job, [f"_by{i}" for i in range(len(by))]
        rest = [c for c in self.columns if c != job.key]
        keyed = rows.select("*", *[c.alias(n) for c, n in zip(by, names, strict=True)])
        return latest_per_key(keyed, [job.key, *names], list(job.order), rest).select(self.columns)

    def buckets(self, rows: DataFrame) -> list[int]:
        """Those of the rows' keys: `state_buckets` numbers at most."""
        return [r[0] for r in rows.select(self.bucket).distinct().collect()]

    def around(self, rows: DataFrame, met: DataFrame, epoch: int) -> tuple[DataFrame, DataFrame]:
        """Of the keys of `rows`: each one's last stored row before its first new row, and the stored rows after that.
        `met` (`meeting`) is persisted."""
        job, clock = self.job, self.job.order[0]
        at = order_key(list(job.order))
        before = met.where(at < F.col("_low")).select(self.columns)
        late = met.where(at >= F.col("_low")).select(job.key, "_low")
        day = F.date_trunc("day", f"_low.{clock}")
        first = late.agg(F.min(day).alias("day"), F.unix_micros(F.min(day)).alias("micros"), F.count(F.lit(1)).alias("keys")).first()
        if first["day"] is None:
            return before, before.limit(0)
        if first["keys"] <= BROADCAST_KEYS:
            late = F.broadcast(late)
        near = self.rows.read(epoch, low=first["micros"]).where(F.unix_micros(clock) >= first["micros"]).join(late, job.key)
        far = self.tails.read(epoch, high=first["micros"]).where(F.unix_micros(clock) < first["micros"]).join(late, job.key)
        earlier = near.where(at < F.col("_low")).select(self.columns).unionByName(far.select(self.columns))
        return before.unionByName(self.latest(earlier)), near.where(at > F.col("_low")).select(self.columns)

    def meeting(self, rows: DataFrame, last: DataFrame) -> DataFrame:
        """The last stored row of each key that has new rows, with the place of the first of these."""
        lowest = rows.groupBy(self.job.key).agg(F.min(order_key(list(self.job.order))).alias("_low"))
        return last.join(lowest, self.job.key)

    def keep(self, rows: DataFrame, last: DataFrame, epoch: int) -> None:
        self.rows.append(rows, epoch)
        tails = self.tails.rows_of(self.tails.append(self.latest(rows, F.to_date(self.job.order[0])), epoch))
        self.state.replace(self.latest(last.unionByName(tails)), epoch)


def combined(rows: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """The new rows, marked `_new`, and the stored ones around them."""
    return rows.withColumn("_new", F.lit(True)).unionByName(before.unionByName(after).withColumn("_new", F.lit(False)))


def is_calm(rows: DataFrame, job: Job, settings: Settings) -> bool:
    """Whether no key is hot. Only the keys are read."""
    return rows.groupBy(job.key).count().where(F.col("count") > settings.hot_key_rows).isEmpty()


def derive(found: DataFrame, job: Job, settings: Settings, calm: bool) -> DataFrame:
    """The new rows and the stored ones behind a new one, with struct `prev`. Only if a key is hot are sequences cut."""
    cut = found if calm else slice_hot_keys(found, [job.key], micros(job.order[0]), settings)
    place = F.struct(*job.order)
    line = Window.partitionBy(job.key, *([] if calm else [SLICE])).orderBy(*[F.col(c).asc_nulls_last() for c in job.order], F.col("_new").desc())
    # A row delivered twice is one row; the new one counts. Its copies stand side by side, in the order that is needed next.
    once = cut.withColumn("_copy", F.lag(place).over(line).eqNullSafe(place)).where(~F.col("_copy")).drop("_copy")
    ordered = uncut(previous_row(whole(once) if calm else once, [job.key], list(job.order), [*job.carry, "_new"]))
    changed = ordered.where(F.col("_new") | F.coalesce("prev._new", F.lit(False)))
    prev = F.when(F.col("prev").isNotNull(), F.struct(*[F.col(f"prev.{c}").alias(c) for c in job.carry]))
    return changed.withColumn("prev", prev).drop("_new")


def _results(spark: SparkSession, root: str, schema: StructType) -> Table:
    return Table(spark, f"{root}/out", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields))


def start(
    stream: DataFrame, job: Job, root: str, settings: Settings = Settings(), every: str | None = None
) -> StreamingQuery:
    """Rows without key or time form no sequence and are left out. `every=None` stops once all input is done."""

    def store(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        rows = batch.where(F.col(job.key).isNotNull() & F.col(job.order[0]).isNotNull()).persist()
        held = [rows]
        try:
            tables = Store(spark, root, job, rows.schema, settings)
            last = tables.state.read(epoch, buckets=tables.buckets(rows))
            met = tables.meeting(rows, last).persist()
            held.append(met)
            found = combined(rows, *tables.around(rows, met, epoch))
            calm = is_calm(found, job, settings)
            if not calm:
                held.append(found.persist())  # read several times to be cut
            derived = derive(found, job, settings, calm).withColumn("epoch", F.lit(epoch).cast("long"))
            _results(spark, root, derived.schema).append(derived, epoch)
            tables.keep(rows, last, epoch)
        finally:
            for table in held:
                table.unpersist()

    writer = job.rows(stream).writeStream.option("checkpointLocation", f"{root}/checkpoint").foreachBatch(store)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def read(stream: DataFrame, job: Job, root: str, settings: Settings = Settings()) -> DataFrame:
    """The job's result over everything stored so far. Of the stream only the columns are used."""
    spark, schema = stream.sparkSession, job.rows(stream).schema
    fields = {f.name: f for f in schema.fields}
    prev = StructField("prev", StructType([fields[c] for c in job.carry]))
    versions = _results(spark, root, StructType([*schema.fields, prev, StructField("epoch", LongType())])).read()
    # A row has few versions, so they are ordered, not aggregated: its last one has none behind it.
    later = F.lead("epoch").over(Window.partitionBy(job.key, *job.order).orderBy("epoch"))
    newest = versions.withColumn("_later", later).where("_later is null").drop("_later", "epoch")
    return job.result(newest, settings)


def _deltas(rows: DataFrame, settings: Settings) -> DataFrame:
    moved = F.col("donation_amount_eur") - F.col("prev.donation_amount_eur")
    return rows.select(
        "snapshot_id", "twitch_login", "display_name", "viewer_count", "donation_amount_eur", "ingested_at",
        F.col("prev.ingested_at").alias("prev_ingested_at"),
        F.coalesce(moved, F.lit(0)).cast(MONEY).alias("donation_delta_eur"),
        seconds_between("prev.ingested_at", "ingested_at").alias("seconds_since_prev_snapshot"),
    )


def _mode_rows(snapshots: DataFrame) -> DataFrame:
    return snapshots.select(
        F.lit("event").alias("event"), "id", "ingested_at", "website_mode", "total_donation_amount_eur", "total_viewer_count"
    )


def _modes(rows: DataFrame, settings: Settings) -> DataFrame:
    return rows.where(~F.col("website_mode").eqNullSafe(F.col("prev.website_mode"))).select(
        F.col("id").alias("snapshot_id"), F.col("ingested_at").alias("changed_at"),
        F.col("prev.website_mode").alias("prev_website_mode"), F.col("website_mode").alias("new_website_mode"),
        "total_donation_amount_eur", "total_viewer_count",
    )


def _hops(rows: DataFrame, settings: Settings) -> DataFrame:
    gap = seconds_between("prev.message_sent_at", "message_sent_at")
    moved = (F.col("channel") != F.col("prev.channel")) & (gap <= settings.hop_max_gap_minutes * 60)
    return rows.where(moved).select(
        "chatter_id", F.col("prev.channel").alias("from_channel"), F.col("channel").alias("to_channel"),
        F.col("prev.message_sent_at").alias("departed_at"), F.col("message_sent_at").alias("arrived_at"), gap.alias("gap_seconds"),
    )


# The batch models `donation_deltas`, `mode_changes` and `chat_channel_hops` on streams of exploded
# snapshots, bronze snapshots (one row per poll) and chat.
DONATION_DELTAS = Job(
    lambda s: s.select("snapshot_id", "twitch_login", "display_name", "viewer_count", "donation_amount_eur", "ingested_at"),
    "twitch_login", ("ingested_at", "snapshot_id"), ("donation_amount_eur", "ingested_at"), _deltas,
)
MODE_CHANGES = Job(_mode_rows, "event", ("ingested_at", "id"), ("website_mode",), _modes)
CHANNEL_HOPS = Job(
    lambda s: s.select("chatter_id", "channel", "message_sent_at", "id"),
    "chatter_id", ("message_sent_at", "id"), ("channel", "message_sent_at"), _hops,
)
