"""Sharding by a k-d tree over document metadata.

All leaves of one depth are split together: each along its widest dimension, at the weighted median of size.
Width is the distance between the 10th and the 90th percentile of the leaf's rows, relative to that of all rows,
so one value far off neither decides the dimension nor the cut. The medians are found by summing sizes in bins of
the values and looking into the bin that holds the middle, until a single value is left: they are exact whatever
the values are, and only nodes x BINS sums reach the driver, whatever the number of rows. Rows that share the
median value, such as those of a hot source, are split by a hash of id and text; only rows equal in all of it stay
together. Splitting ends at the depth whose leaves have the target bytes.

Dimensions are whole numbers. Null texts have size 1 and checksum 0; null or unknown metadata come first. An empty
table gives an empty result. Rows repeated in full get slots of their own. Texts of any length are only measured.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamtally.llm.common import gapless, written

TIE_BITS = 28
BIN_BITS = 13  # a round finds this many bits of a median
LOW, HIGH = 0.1, 0.9  # percentiles between which a dimension's width is taken


def measured(df: DataFrame, dimensions: dict[str, Column]) -> DataFrame:
    """doc_id, size, text_crc32, tie and the dimensions as longs d0, d1, ...; null: below all values."""
    text = F.coalesce(F.col("text"), F.lit(""))
    tie = F.shiftrightunsigned(F.xxhash64("doc_id", text), 64 - TIE_BITS)
    return df.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        tie.alias("tie"),
        *[c.cast("long").alias(f"d{i}") for i, c in enumerate(dimensions.values())],
    )


def text_place(c: Column) -> Column:
    """A number in the order of the text's first six bytes."""
    return F.conv(F.rpad(F.substring(F.hex(c.cast("binary")), 1, 12), 12, "0"), 16, 10)


@dataclass
class Extent:
    """Of one node and dimension: least and greatest value, and the percentiles; None if all are null."""

    least: int | None
    greatest: int | None
    low: int | None
    high: int | None

    @property
    def width(self) -> int:
        return 0 if self.low is None else self.high - self.low


def _extents(rows: DataFrame, n: int) -> dict[int, list[Extent]]:
    """One row a node reaches the driver."""
    found = []
    for i in range(n):
        found += [F.min(f"d{i}").alias(f"min{i}"), F.max(f"d{i}").alias(f"max{i}"), F.percentile_approx(f"d{i}", [LOW, HIGH], 10_000).alias(f"p{i}")]
    return {
        r["node"]: [Extent(r[f"min{i}"], r[f"max{i}"], *(r[f"p{i}"] or (None, None))) for i in range(n)]
        for r in rows.groupBy("node").agg(*found).collect()
    }


def _choice(nodes: dict[int, Column], default: Column) -> Column:
    out = default
    for node, value in nodes.items():
        out = F.when(F.col("node") == node, value).otherwise(out)
    return out


def _middle(rows: DataFrame, key: str, bits: int, half: dict[int, float], below: dict[int, int]) -> dict[int, int]:
    """Per node the least key (of so many bits) up to which rows have `half` of the size. `below` is the size that
    comes before these rows, and after it the size that comes before the key."""
    low, shift = dict.fromkeys(half, 0), bits
    while shift:
        step = min(BIN_BITS, shift)
        shift -= step
        prefix = _choice({n: F.lit(low[n] >> (shift + step)) for n in half}, F.lit(-1))
        inside = rows.where(F.shiftright(key, shift + step) == prefix) if shift + step < 64 else rows
        bins = inside.groupBy("node", F.shiftright(key, shift).alias("bin")).agg(F.sum("size").alias("w"))
        sums: dict[int, list[tuple[int, int]]] = {}
        for r in bins.collect():  # nodes x 2^BIN_BITS at most
            sums.setdefault(r["node"], []).append((r["bin"], int(r["w"])))
        for n, parts in sums.items():
            for place, w in sorted(parts):
                low[n] = place << shift
                if below[n] + w >= half[n]:
                    break
                below[n] += w
    return low


def _split(rows: DataFrame, n: int, whole: list[Extent]) -> DataFrame:
    """Rows with the node of the next depth."""
    extents = _extents(rows, n)
    values, bits = {}, 1
    for node, own in extents.items():
        shares = [e.width / w.width if w.width else 0.0 for e, w in zip(own, whole, strict=True)]
        widest = max(range(n), key=lambda i: (shares[i], -i))
        least, greatest = own[widest].least or 0, own[widest].greatest or 0
        # Values further apart than a long can tell are cut by all but their last bits.
        coarse = max(0, (greatest - least + 1).bit_length() - 62)
        values[node] = F.coalesce(F.shiftright(f"d{widest}", coarse) - F.lit(least >> coarse) + 1, F.lit(0).cast("long"))
        bits = max(bits, ((greatest >> coarse) - (least >> coarse) + 1).bit_length())
    keyed = rows.withColumn("key", _choice(values, F.lit(0).cast("long")))
    half = {r["node"]: int(r["w"]) / 2 for r in rows.groupBy("node").agg(F.sum("size").alias("w")).collect()}
    below = dict.fromkeys(half, 0)
    value = _middle(keyed, "key", bits, half, below)
    at_value = F.col("key") == _choice({k: F.lit(v) for k, v in value.items()}, F.lit(-1))
    tie = _middle(keyed.where(at_value), "tie", TIE_BITS, half, below)
    beyond = _choice({k: F.col("key") > v for k, v in value.items()}, F.lit(False))
    beyond_tie = _choice({k: F.col("tie") > v for k, v in tie.items()}, F.lit(False))
    return keyed.withColumn("node", F.col("node") * 2 + (beyond | (at_value & beyond_tie)).cast("int")).drop("key")


def shard(df: DataFrame, dimensions: dict[str, Column], target_bytes: int | None = None, shards: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (gapless from 0 in each shard) of every row.

    Give either the bytes a leaf may have at most or the number of leaves, a power of two.
    """
    n = len(dimensions)
    rows = written(measured(df, dimensions), "shards").withColumn("node", F.lit(0))
    whole = _extents(rows, n).get(0)
    if whole is None:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    if shards is None:
        weight = rows.agg(F.sum("size")).first()[0]
        shards = 1 << max(0, math.ceil(math.log2(weight / target_bytes)))
    for _ in range(int(math.log2(shards))):
        rows = _split(rows, n, whole)
    placed = rows.select("doc_id", "size", "text_crc32", "tie", F.col("node").alias("shard"))
    numbered = gapless(placed, ["shard"], [F.col("tie"), F.col("doc_id"), F.col("text_crc32")], "slot")
    return numbered.drop("tie")


def metadata_dimensions() -> dict[str, Column]:
    """Of the documents table."""
    return {
        "doc_id": F.col("doc_id"),
        "n_chars": F.col("n_chars"),
        "source": text_place(F.col("source")),
        "lang": text_place(F.col("lang")),
    }
