"""How filters overlap: the removal game of five filters, by its Hart-Mas-Colell potential.

The worth v(S) of a coalition S of filters is the number of documents that fail at least one of them.
Its potential is P(S) = (v(S) + sum of P(S without i) over i in S) / |S|, with P of none 0; a filter's
Shapley value is P(all) - P(all without it). 60 P is whole for five players, so all of it is done in
whole numbers. Whatever a step of a filter order removes is a difference of two coalitions:

    removed here = v(before + f) - v(before)        redundant = v(f) - removed here
    kept = documents - v(before + f)                 fails f only = v(all) - v(all without f)

Documents become one failure mask each; what moves are digests, ids and counts, never texts. Copies of
one text are counted before they meet, so a text that a third of the documents share is a few rows.

Defined results: a null text counts as empty, a null `lang` as the empty string, which is a part like any
other; an empty table has no parts and no rows. A row without doc_id is later than all rows with one and
never earlier than another; rows that share an id are documents of their own. Several label rows of one
document count as one that has quality 1 (toxic 1) if any of them has. Extra columns are ignored.
"""

from __future__ import annotations

import json
from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PCT = 50
MAX_UPPER_PCT = 3
SYMBOLS = "[#$%&*|]"
WORD_BREAK = "[\\x20\\x09-\\x0D]+"

ALL = (1 << len(FILTERS)) - 1
EARLIER_COPY = 1 << FILTERS.index("E")
ORDERS = factorial(len(FILTERS))


def text_failures(text: Column) -> Column:
    """Mask of the filters A to D that a text fails."""
    words = F.filter(F.split(text, WORD_BREAK), lambda w: w != "")
    counted = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))[0]
    upper = F.regexp_count(text, F.lit("[A-Z]"))
    fails = [
        counted["n"] < MIN_WORDS,
        100 * counted["d"] < MIN_DISTINCT_PCT * counted["n"],
        100 * upper > MAX_UPPER_PCT * F.length(text),
        text.rlike(SYMBOLS),
    ]
    return reduce(lambda a, b: a + b, [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)])


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, documents, good, toxic: documents by the set of filters they fail."""
    text = F.coalesce("text", F.lit(""))
    seen = docs.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.sha2(text, 256).alias("digest"), text_failures(text).alias("mask")
    )
    known = labels.groupBy(F.col("doc_id").alias("label_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    labelled = seen.join(known, seen["doc_id"] == known["label_id"], "left").select(
        "doc_id", "part", "digest", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")
    )
    kind = ["digest", "mask", "part", "good", "toxic"]
    rows = labelled.groupBy("doc_id", *kind).agg(F.count(F.lit(1)).alias("n"))
    lowest = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    copies = rows.groupBy(*kind).agg(F.sum("n").alias("n"), lowest.alias("lowest"))
    # At most parts x 4 rows of a digest are left.
    first = F.min("lowest.doc_id").over(Window.partitionBy("digest"))
    fresh = F.when(first.isNull(), F.col("n")).when(F.col("lowest.doc_id") == first, F.col("lowest.n")).otherwise(0)
    split = copies.select("part", "mask", "good", "toxic", "n", fresh.alias("fresh"))
    either = F.array(
        F.struct(F.col("mask").alias("fails"), F.col("fresh").alias("documents")),
        F.struct((F.col("mask") + EARLIER_COPY).alias("fails"), (F.col("n") - F.col("fresh")).alias("documents")),
    )
    each = split.select("part", "good", "toxic", F.inline(either))
    count = lambda which: F.sum(F.when(F.col(which), F.col("documents")).otherwise(0)).alias(which)
    return each.groupBy("part", F.col("fails").alias("mask")).agg(count("good"), count("toxic"), F.sum("documents").alias("documents"))


def worths(masks: DataFrame) -> DataFrame:
    """part, documents, and arrays by coalition (0 to 31) of the documents, good and toxic ones it removes."""

    def of(value: str) -> Column:
        lost = [F.sum(F.when(F.col("mask").bitwiseAND(F.lit(s)) != 0, F.col(value)).otherwise(0)) for s in range(ALL + 1)]
        return F.array(*lost)

    return masks.groupBy("part").agg(
        F.sum("documents").alias("total"), of("documents").alias("worth"), of("good").alias("good"), of("toxic").alias("toxic")
    )


def potentials(games: DataFrame) -> DataFrame:
    """The same with `potential`, an array by coalition of 120 times the potential.

    A fold over the coalitions in ascending order: every smaller coalition is there before it is needed.
    """
    members = [[s & ~(1 << i) for i in range(len(FILTERS)) if s >> i & 1] for s in range(ALL + 1)]
    below = F.array(*[F.array(*[F.lit(s) for s in m]) if m else F.array().cast("array<int>") for m in members])

    def step(done: Column, s: Column) -> Column:
        smaller = F.element_at(below, s + 1)
        known = F.aggregate(smaller, F.lit(0).cast("long"), lambda total, t: total + F.element_at(done, t + 1))
        scaled = F.element_at(F.col("worth"), s + 1) * ORDERS + known
        return F.concat(done, F.array(F.call_function("div", scaled, F.size(smaller).cast("long"))))

    start = F.array(F.lit(0).cast("long"))
    return games.withColumn("potential", F.aggregate(F.sequence(F.lit(1), F.lit(ALL)), start, step))


def shapley(games: DataFrame) -> DataFrame:
    """part, filter, shapley (removed by the filter, summed over all 120 orders) of `potentials`."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("filter"), F.lit(ALL & ~(1 << i)).alias("rest")) for i, f in enumerate(FILTERS)]))
    grand = F.element_at("potential", ALL + 1)
    split = games.select("part", "potential", each.alias("x"))
    return split.select("part", F.col("x.filter").alias("filter"), (grand - F.element_at("potential", F.col("x.rest") + 1)).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley: each
    step of each order of the five filters, for every part."""
    steps = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for k, f in enumerate(order):
            steps.append(("".join(FILTERS[i] for i in order), k + 1, 1 << f, before))
            before |= 1 << f
    # 600 rows a part, from one constant.
    fields = ("filter_order", "step", "own", "before")
    listed = F.lit(json.dumps([dict(zip(fields, s, strict=True)) for s in steps]))
    each = F.inline(F.from_json(listed, "array<struct<filter_order:string,step:int,own:int,before:int>>"))
    rows = potentials(worths(failures(docs, labels))).select("part", "total", "worth", "good", "toxic", "potential", each)

    at = lambda name, s: F.element_at(name, s + 1)
    own, before = F.col("own"), F.col("before")
    after, rest = own.bitwiseOR(before), F.lit(ALL) - own
    removed = at("worth", after) - at("worth", before)
    return rows.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - at("worth", after)).alias("kept"),
        removed.alias("removed"),
        (at("worth", own) - removed).alias("redundant"),
        (at("worth", F.lit(ALL)) - at("worth", rest)).alias("unique_fails"),
        (at("good", after) - at("good", before)).alias("good_lost"),
        (at("toxic", after) - at("toxic", before)).alias("toxic_lost"),
        (at("potential", F.lit(ALL)) - at("potential", rest)).alias("shapley"),
    )
