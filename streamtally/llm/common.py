"""What several of the text operators need: written intermediate tables, gapless numbers, batches of texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from streamtally.session import scratch_dir


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared scratch folder: computed once, readable after any executor is lost."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_batches(batches: Iterator[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about `max_bytes`, so that what a task holds does not grow with the batch."""
    for batch in batches:
        if batch.num_rows:
            step = max(1, batch.num_rows * max_bytes // max(batch.nbytes, max_bytes))
            for start in range(0, batch.num_rows, step):
                yield batch.slice(start, step)


def map_texts(
    df: DataFrame, columns: list[str | Column], make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """Runs the function that `make` builds once a task over the batches of these columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in text_batches(batches):
            yield work(batch)

    return df.select(*columns).mapInArrow(run, schema)


def gapless(df: DataFrame, keys: list[str], order: list[Column], number: str, start_at: int = 0) -> DataFrame:
    """Numbers the rows of each key without gaps. No task sees a whole key: rows are numbered within
    hashed cells, and the cells' counts, a table of at most keys x cells rows, are summed in order.

    `order` has to be deterministic; rows equal in all of it are interchangeable.
    """
    cells = 4 * partitions(df.sparkSession)
    cell, first = f"__{number}_cell", f"__{number}_first"
    placed = df.withColumn(cell, F.pmod(F.xxhash64(*order), F.lit(cells)).cast("int"))
    counts = placed.groupBy(*keys, cell).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, cell, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(first))
    within = placed.withColumn("__r", F.row_number().over(Window.partitionBy(*keys, cell).orderBy(*order)))
    joined = within.alias("l").join(
        offsets.alias("r"), [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*keys, cell]]
    )
    kept = [F.col(f"l.{c}") for c in df.columns]
    return joined.select(*kept, (F.col(first) + F.col("__r") - 1 + start_at).cast("long").alias(number))
