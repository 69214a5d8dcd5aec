"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamtally.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """id, label for each id in the edges (a, b): the smallest id reachable.

    Every id points to its smallest neighbour if that is smaller, pointers are followed to their ends by
    doubling, and the edges between the ends are the next round's, until none is left. A round at least
    halves the ids that still have edges. All of it is joins and sums of tables written between the steps.
    Null ids and edges from an id to itself are ignored, ids of such edges alone are not returned.
    """
    valid = edges.where("a is not null and b is not null and a <> b")
    rest = written(valid.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    rounds: list[DataFrame] = []
    while not rest.isEmpty():
        ends = rest.select("a", "b").union(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = written(ends.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("to")), "pointers")
        moving = True
        while moving:
            onward = to.select(F.col("id").alias("to"), F.col("to").alias("next"))
            step = to.join(onward, "to").select("id", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved"))
            step = written(step, "pointers")
            moving = not step.where("moved").isEmpty()
            to = step.select("id", "to")
        rounds.append(to)
        left, right = to.select(F.col("id").alias("a"), F.col("to").alias("ta")), to.select(F.col("id").alias("b"), F.col("to").alias("tb"))
        moved = rest.join(left, "a").join(right, "b").where("ta <> tb")
        rest = written(moved.select(F.greatest("ta", "tb").alias("a"), F.least("ta", "tb").alias("b")).distinct(), "edges")
    if not rounds:
        return edges.sparkSession.createDataFrame([], "id long, label long")
    labels = rounds[-1].select("id", F.col("to").alias("label"))
    for to in reversed(rounds[:-1]):
        up = labels.select(F.col("id").alias("to"), "label")
        labels = to.join(up, "to", "left").select("id", F.coalesce("label", "to").alias("label"))
    return labels
