"""How many members two nodes share, for every pair of nodes with any."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamtally.settings import Settings


def shared_members(
    edges: DataFrame, keys: Sequence[str], member: str, node: str, weight: str, settings: Settings
) -> DataFrame:
    """(keys, node_a < node_b, shared, overlap): members on both nodes, and the sum over
    them of the smaller of their two weights. `edges` is unique on (keys, member, node).

    Members with identical weighted node sets are collapsed to one row with a count
    before any pair is formed, so the most common sets - the hot groups - cost one row
    each. A set is never longer than the number of nodes. A long set is worked off in
    several pieces that the collapsing shuffle spreads over tasks, and the partial
    aggregate behind the expansion folds pairs before they are shuffled.
    """
    # ceil(pairs / limit) pieces; pieces take the set's positions in turn.
    size = F.size("_set")
    pieces = F.ceil(size * (size - 1) / F.lit(2.0 * settings.pairs_per_piece)).cast("int")
    sets = (
        edges.groupBy(*keys, member)
        .agg(F.sort_array(F.collect_list(F.struct(F.col(node).alias("n"), F.col(weight).alias("w")))).alias("_set"))
        .where(size > 1)
        .withColumn("_pieces", pieces)
        .withColumn("_piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)))
        .groupBy(*keys, "_set", "_pieces", "_piece")
        .agg(F.count(F.lit(1)).alias("_members"))
    )
    lower = sets.select("*", F.posexplode("_set").alias("_at", "_a")).where(
        F.col("_at") % F.col("_pieces") == F.col("_piece")
    )
    pairs = lower.select(
        *keys, "_members", "_a", F.explode(F.slice("_set", F.col("_at") + 2, size)).alias("_b")
    )
    return (
        pairs.groupBy(*keys, F.col("_a.n").alias("node_a"), F.col("_b.n").alias("node_b"))
        .agg(
            F.sum("_members").alias("shared"),
            F.sum(F.col("_members") * F.least("_a.w", "_b.w")).alias("overlap"),
        )
    )
