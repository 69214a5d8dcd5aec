"""A stream written as files that are closed by time or by row count, whichever comes first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from streamtally.sources.table_log import Table

ROLL_SECONDS = 30
ROLL_ROWS = 100_000


def table(stream: DataFrame, path: str, clock: str | None = None, rows_per_file: int = ROLL_ROWS) -> Table:
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields)
    return Table(stream.sparkSession, path, fields, clock, rows_per_file=rows_per_file)


def start(
    stream: DataFrame, path: str, checkpoint: str, clock: str | None = None, rows_per_file: int = ROLL_ROWS, every: str | None = f"{ROLL_SECONDS} seconds"
) -> StreamingQuery:
    """A micro-batch every `every` closes its files, none of them with more than `rows_per_file` rows, and neither
    have those into which small ones are merged later. A micro-batch is one commit: a repeated one overwrites what it
    wrote, and readers of `table` never see half of it. `every=None` stops once all available input is written."""
    target = table(stream, path, clock, rows_per_file)

    def store(batch: DataFrame, epoch: int) -> None:
        # Small partitions are put together, so that a quiet half minute is one file and not one a task.
        target.append(batch.hint("rebalance"), epoch)

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
