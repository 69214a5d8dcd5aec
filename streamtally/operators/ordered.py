"""Ordered per-key sequences (previous row, running sum, last known value)
that stay parallel when one key holds a large share of the rows.

A window partition cannot be split by Spark, so a window over a hot key runs in
one task. Here the sequence of a hot key is first cut into slices along its
ordering axis; the window runs inside (key, slice), and what crosses a slice
boundary comes from a summary of one row per (hot key, slice), joined back on
the same (key, slice) the rows are already partitioned by. Ordinary keys form a
single slice and pay only for the hot-key lookup.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamtally.settings import Settings

SLICE = "_slice"
_CUT_FROM = "_cut_from"
SLICES = [SLICE, _CUT_FROM]
_WHOLE = -1  # slice of a key that was not cut
CELLS = 1 << 24


def micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts))


def order_key(order: Sequence[str]) -> Column:
    """Ascending, nulls last, as one comparable struct for max_by / min_by."""
    return F.struct(*[part for name in order for part in (F.col(name).isNull(), F.col(name))])


def _ascending(order: Sequence[str]) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in order]


def _slice_of(starts: Column, cell: Column, most: int) -> Column:
    """Number of the last of the ascending `starts` at or below the cell, by halving."""
    steps = F.sequence(F.lit(1), F.lit(max(1, most.bit_length())))
    whole = F.struct(F.lit(1).alias("low"), F.size(starts).alias("high"))

    def halve(span: Column, _: Column) -> Column:
        middle = F.floor((span["low"] + span["high"] + 1) / 2).cast("int")
        below = F.element_at(starts, middle) <= cell
        return F.struct(
            F.when(below, middle).otherwise(span["low"]).alias("low"),
            F.when(below, span["high"]).otherwise(F.greatest(middle - 1, span["low"])).alias("high"),
        )

    return F.aggregate(steps, whole, halve, lambda span: span["low"])


def slice_hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    axis: Column,
    settings: Settings,
    nulls_first: bool = False,
    extent_of: DataFrame | None = None,
    name: str | None = None,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Adds `_slice`; slices of one key are ordered like `axis`.

    With `Settings.key_stats` the borders of a sequence that has a `name` come from there: they are measured once,
    and rows with equal axis values are cut by `ties`. The rest is about finding them inside the plan.

    A hot key is cut by row count: its rows are counted in CELLS equal cells between its smallest and
    greatest axis value, and a slice takes cells until it has `hot_slice_rows`. Skewed values and single
    outliers thus do not matter as long as a cell stays small; rows with equal axis values stay together.
    The borders are exact counts, hence a pure function of the data: a recomputed partition lands in
    the same slices. The broadcast table has at most rows / hot_slice_rows borders. Where `df` is costly
    to compute, pass in `extent_of` a cheaper table with the same keys and axis values.
    """
    by = list(keys)
    if settings.key_stats is not None and name is not None:
        return _cut_at_borders(df, by, axis, settings, nulls_first, df if extent_of is None else extent_of, name, ties)
    spread = df.withColumn("_axis", axis.cast("double"))
    measured = spread if extent_of is None else extent_of.withColumn("_axis", axis.cast("double"))
    extent = [F.count(F.lit(1)).alias("_n"), F.min("_axis").alias("_lo"), F.max("_axis").alias("_hi")]
    large = F.col("_n") > settings.hot_key_rows
    place = F.floor((F.col("_axis") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * F.lit(float(CELLS)))
    cell = F.when(F.col("_hi") > F.col("_lo"), F.least(place, F.lit(CELLS - 1))).otherwise(F.lit(0)).cast("int")
    earlier = Window.partitionBy(*by).orderBy("_slice_cell").rowsBetween(Window.unboundedPreceding, -1)
    number = F.floor(F.coalesce(F.sum("count").over(earlier), F.lit(0)) / F.lit(settings.hot_slice_rows))

    def borders(hot_rows: DataFrame, kept: Sequence[str]) -> DataFrame:
        counted = hot_rows.where(F.col("_axis").isNotNull()).groupBy(*kept, cell.alias("_slice_cell")).count()
        firsts = counted.withColumn("_number", number).groupBy(*kept, "_number").agg(F.min("_slice_cell").alias("_first"))
        return firsts.groupBy(*kept).agg(F.array_sort(F.collect_list("_first")).alias("_starts"))

    if keys:
        hot = measured.groupBy(*by).agg(*extent).where(large).select(*by, "_lo", "_hi")
        kept = [*by, "_lo", "_hi"]
        joined = spread.join(F.broadcast(borders(measured.join(F.broadcast(hot), by), kept)), by, "left")
    else:
        # One row; as scalars it needs no join, and a short sequence is not read again.
        total = measured.agg(*extent)
        ends = {c: total.select(F.when(large, F.col(c))).scalar() for c in ("_lo", "_hi")}
        starts = borders(measured.withColumns(ends).where(F.col("_lo").isNotNull()), []).select("_starts").scalar()
        joined = spread.withColumns({**ends, "_starts": starts})
    cut = (
        F.when(F.col("_lo").isNull(), F.lit(_WHOLE))
        .when(F.col("_axis").isNull(), F.lit(0) if nulls_first else F.size("_starts") + 1)
        .otherwise(_slice_of(F.col("_starts"), cell, CELLS))
    )
    sliced = joined.withColumn(SLICE, cut.cast("int")).withColumnRenamed("_lo", _CUT_FROM)
    return sliced.drop("_axis", "_hi", "_starts")


def _cut_at_borders(
    df: DataFrame, by: list[str], axis: Column, settings: Settings, nulls_first: bool, measured: DataFrame, name: str, ties: Sequence[str]
) -> DataFrame:
    tied = [part for i, t in enumerate(ties) for part in (F.col(t).isNull().alias(f"n{i}"), F.col(t).alias(f"t{i}"))]
    position = F.struct(axis.cast("double").alias("axis"), *tied)
    borders = settings.key_stats.borders(name, measured, by, position, settings.hot_key_rows, settings.hot_slice_rows).table
    if borders is None:
        return whole(df)
    if by:
        joined = df.join(F.broadcast(borders), by, "left")
    else:
        joined = df.withColumns({c: borders.select(c).scalar() for c in ("_starts", "_from")})
    cut = (
        F.when(F.col("_from").isNull(), F.lit(_WHOLE))
        .when(axis.isNull(), F.lit(0) if nulls_first else F.size("_starts") + 1)
        .otherwise(_slice_of(F.col("_starts"), position, CELLS))
    )
    return joined.withColumn(SLICE, cut.cast("int")).withColumnRenamed("_from", _CUT_FROM).drop("_starts")


def whole(df: DataFrame) -> DataFrame:
    """The rows as sequences that are not cut: without hot keys, every ordered operator on them is a plain window."""
    return df.withColumns({SLICE: F.lit(_WHOLE), _CUT_FROM: F.lit(None).cast("double")})


def uncut(df: DataFrame) -> DataFrame:
    """Drops the helper columns of `slice_hot_keys`."""
    return df.drop(*SLICES)


def _cut_only(df: DataFrame) -> DataFrame:
    """Rows of hot keys. The test is on a column of the hot-key table, so the lookup becomes
    an inner join and, with no hot key, adaptive execution drops the whole branch unread."""
    return df.where(F.col(_CUT_FROM).isNotNull())


def _across_slices(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys).orderBy(SLICE)


def _neighbour(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], carry: Sequence[str], into: str, ahead: bool
) -> DataFrame:
    fields = F.struct(*carry)
    step, pick = (F.lead, F.min_by) if ahead else (F.lag, F.max_by)
    window = Window.partitionBy(*keys, SLICE).orderBy(*_ascending(order))
    inside = df.withColumn(into, step(fields).over(window))
    borders = (
        _cut_only(df)
        .groupBy(*keys, SLICE)
        .agg(pick(fields, order_key(order)).alias("_border"))
        .withColumn("_border", step("_border").over(_across_slices(keys)))
    )
    return (
        inside.join(borders, [*keys, SLICE], "left")
        .withColumn(into, F.coalesce(into, "_border"))
        .drop("_border")
    )


def previous_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], carry: Sequence[str], into: str = "prev"
) -> DataFrame:
    """Adds struct `into` with the `carry` columns of the preceding row, null on the first.

    `df` must carry `_slice`, cut along the first column of `order`.
    """
    return _neighbour(df, keys, order, carry, into, ahead=False)


def next_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], carry: Sequence[str], into: str = "next"
) -> DataFrame:
    return _neighbour(df, keys, order, carry, into, ahead=True)


def running_sum(
    df: DataFrame, keys: Sequence[str], window_order: Sequence[Column], value: str, into: str
) -> DataFrame:
    """Adds the sum of `value` from the key's first row up to and including this one."""
    window = (
        Window.partitionBy(*keys, SLICE)
        .orderBy(*window_order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = _across_slices(keys).rowsBetween(Window.unboundedPreceding, -1)
    inside = df.withColumn(into, F.sum(value).over(window))
    offsets = (
        _cut_only(df)
        .groupBy(*keys, SLICE)
        .agg(F.sum(value).alias("_offset"))
        .withColumn("_offset", F.sum("_offset").over(earlier))
    )
    return (
        inside.join(offsets, [*keys, SLICE], "left")
        .withColumn(into, F.col(into) + F.coalesce("_offset", F.lit(0)))
        .drop("_offset")
    )


def last_known(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Replaces nulls in `columns` by the key's latest earlier non-null value."""
    window = (
        Window.partitionBy(*keys, SLICE)
        .orderBy(*_ascending(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = _across_slices(keys).rowsBetween(Window.unboundedPreceding, -1)
    key = order_key(order)
    inside = df.withColumns({c: F.last(c, ignorenulls=True).over(window) for c in columns})
    borders = (
        _cut_only(df)
        .groupBy(*keys, SLICE)
        .agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), key)).alias(f"_known_{c}") for c in columns])
        .withColumns({f"_known_{c}": F.last(f"_known_{c}", ignorenulls=True).over(earlier) for c in columns})
    )
    joined = inside.join(borders, [*keys, SLICE], "left")
    return joined.withColumns({c: F.coalesce(c, f"_known_{c}") for c in columns}).drop(
        *[f"_known_{c}" for c in columns]
    )
