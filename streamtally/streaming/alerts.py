"""Channels that fall silent, noticed while the stream runs.

Chat alone cannot tell that it has stopped: without rows there is no micro-batch. So the job also takes a heartbeat,
a stream of moments that go on when chat does not: the polls of the collector, or the `rate` source. Every
micro-batch updates the last message of each channel and compares it with the latest heartbeat. An alert is one
row (channel, last_seen_at); it is raised once, however long the silence goes on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streamtally.sources.table_log import Table
from streamtally.streaming.windows import stalled

SEEN = "channel string, last_seen_at timestamp, heartbeat_at timestamp"
ALERTS = "channel string, last_seen_at timestamp, noticed_at timestamp, silent_minutes double"


def alerts(spark: SparkSession, root: str) -> Table:
    return Table(spark, f"{root}/alerts", ALERTS, "noticed_at")


def _note(batch: DataFrame, epoch: int, root: str, minutes: int) -> None:
    spark = batch.sparkSession
    state, raised = Table(spark, f"{root}/seen", SEEN), alerts(spark, root)
    # One row a channel; the row without channel holds the latest heartbeat.
    last = (
        state.read(epoch)
        .unionByName(batch)
        .groupBy("channel")
        .agg(F.max("last_seen_at").alias("last_seen_at"), F.max("heartbeat_at").alias("heartbeat_at"))
        .persist()
    )
    try:
        state.replace(last, epoch)
        now = last.agg(F.max("heartbeat_at").alias("noticed_at")).select("noticed_at").scalar()
        silent = stalled(last.where(F.col("channel").isNotNull()).drop("heartbeat_at"), now, minutes).withColumn("noticed_at", now)
        raised.append(silent.join(raised.read(epoch).select("channel", "last_seen_at"), ["channel", "last_seen_at"], "left_anti"), epoch)
    finally:
        last.unpersist()


def start(
    chat: DataFrame, heartbeat: DataFrame, root: str, minutes: int, clock: str = "captured_at", every: str | None = "10 seconds"
) -> StreamingQuery:
    """`heartbeat` has one timestamp column. `every=None` stops once all available input is taken in."""
    nothing = F.lit(None).cast("timestamp")
    rows = chat.select("channel", F.col(clock).alias("last_seen_at"), nothing.alias("heartbeat_at")).where("channel is not null")
    beats = heartbeat.select(F.lit(None).cast("string").alias("channel"), nothing.alias("last_seen_at"), F.col(heartbeat.columns[0]).alias("heartbeat_at"))
    writer = rows.unionByName(beats).writeStream.option("checkpointLocation", f"{root}/checkpoint").foreachBatch(
        lambda batch, epoch: _note(batch, epoch, root, minutes)
    )
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
