"""Join of timestamped points to the spans that contain them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamtally.settings import Settings


def points_in_spans(
    points: DataFrame,
    spans: DataFrame,
    key: str,
    ts: str,
    start: str,
    end: str,
    settings: Settings,
) -> DataFrame:
    """Every (span, point) with equal `key` and start <= ts <= end.

    Spans are repeated once per time cell they touch and joined on (key, cell), so
    a point only meets spans near it in time and a busy key is spread over its
    cells. Whether the spans are broadcast is left to their measured size.
    """
    placed = cells_of_spans(spans, start, end, settings)
    located = points.where(F.col(ts).isNotNull()).withColumn("_cell", cell_of(ts, settings))
    return inside_spans(located, placed, key, ts, start, end)


def cell_of(ts: str, settings: Settings) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(settings.interval_cell_seconds * 1_000_000))


def cells_of_spans(spans: DataFrame, start: str, end: str, settings: Settings) -> DataFrame:
    """Each span once per time cell it touches."""
    cells = F.sequence(cell_of(start, settings), cell_of(end, settings))
    return spans.where(F.col(start) <= F.col(end)).withColumn("_cell", F.explode(cells))


def inside_spans(located: DataFrame, placed: DataFrame, key: str, ts: str, start: str, end: str) -> DataFrame:
    """The points in the spans, of rows that have their `_cell`."""
    met = located.join(placed, [key, "_cell"])
    return met.where((F.col(ts) >= F.col(start)) & (F.col(ts) <= F.col(end))).drop("_cell")
