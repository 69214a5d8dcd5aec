"""Running a stream to the end of its available input."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from streamtally.operators.latest import latest_per_key
from streamtally.session import scratch_dir


def deliver(inputs: Iterable[DataFrame], inbox: str, start: Callable[[], StreamingQuery]) -> None:
    """Lays each input into the folder a stream reads and lets the stream work it off before the next."""
    for rows in inputs:
        rows.write.mode("append").parquet(inbox)
        start().awaitTermination()


def drain(spark: SparkSession, stream: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Processes everything available and returns what was emitted. With `keys` the stream runs in
    update mode: every micro-batch writes the rows it changed to a folder of its own, which a repeated
    micro-batch overwrites, and the last row of each key is returned."""
    return drained(spark, stream, scratch_dir(spark, "stream"), keys)


def drained(spark: SparkSession, stream: DataFrame, root: str, keys: Sequence[str] = ()) -> DataFrame:
    """`drain` in a folder of the caller's; called again, it goes on where it stopped."""
    out = f"{root}/out"
    writer = stream.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
    if not keys:
        writer.format("parquet").outputMode("append").option("path", out).start().awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)
    columns = stream.columns

    def store(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    writer.outputMode("update").foreachBatch(store).start().awaitTermination()
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields)
    versions = spark.read.schema(f"{fields}, epoch bigint").parquet(out)
    return latest_per_key(versions, list(keys), ["epoch"], [c for c in columns if c not in keys]).select(columns)
