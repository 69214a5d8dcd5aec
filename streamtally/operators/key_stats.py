"""Key statistics: which keys of a sequence are hot, and where their rows are cut, measured once and written.

Every ordered operator has to know the hot keys of its input. Left to the plan, each of them reads its input again
to find out, and nested sequences multiply that. With `Settings.key_stats` a named sequence is measured when it is
first composed: its keys are counted, and only if one is hot are its rows' positions sorted and every
`hot_slice_rows`-th one kept as a border. The borders are exact whatever the values are, and rows with equal times
are cut by their tie breakers. Sequences without a hot key become plain windows.

Borders are a written table, so all readers see the same ones; borders of older data cut unevenly, not wrongly.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Borders:
    """`table` has the keys, `_starts` (ascending positions) and `_from`; None if no key is hot."""

    table: DataFrame | None


class KeyStats:
    """Statistics under the folder `root`, by name of the sequence."""

    def __init__(self, root: str):
        self.root, self._known = root.rstrip("/"), {}

    def borders(self, name: str, rows: DataFrame, keys: Sequence[str], position: Column, hot_rows: int, slice_rows: int) -> Borders:
        """`rows` needs the keys and what `position` is made of: a struct whose first field is null where there is none."""
        if name not in self._known:
            self._known[name] = self._measured(f"{self.root}/{re.sub('[^a-z]+', '-', name)}", rows, list(keys), position, hot_rows, slice_rows)
        return self._known[name]

    def _measured(self, path: str, rows: DataFrame, keys: list[str], position: Column, hot_rows: int, slice_rows: int) -> Borders:
        placed = rows.select(*keys, position.alias("_pos"))
        large = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
        hot = self._written(large, f"{path}/hot")
        if hot.isEmpty():
            return Borders(None)
        # At most rows / hot_rows keys.
        own = placed.join(F.broadcast(hot.select(*keys)), keys) if keys else placed
        first = f"_pos.{placed.schema['_pos'].dataType.names[0]}"
        tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        in_order = own.where(F.col(first).isNotNull()).repartitionByRange(tasks, *keys, "_pos").sortWithinPartitions(*keys, "_pos")
        ordered = self._written(in_order.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), f"{path}/ordered")
        # One row per task and key of it.
        spans = ordered.groupBy(*keys, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
        earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        spans = spans.select(*keys, "_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
        borders = ordered.join(F.broadcast(spans), [*keys, "_part"]).where((F.col("_at") + F.col("_shift")) % slice_rows == 0)
        table = borders.groupBy(*keys).agg(F.array_sort(F.collect_list("_pos")).alias("_starts")).withColumn("_from", F.lit(0.0))
        return Borders(self._written(table, f"{path}/borders"))

    @staticmethod
    def _written(rows: DataFrame, path: str) -> DataFrame:
        rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)
