"""Document fingerprints by improved consistent weighted sampling.

A document is the multiset of its white-space separated words; a word's weight is its count. For each
of SAMPLES samples a word draws r, c from Gamma(2, 1) and b from the uniform distribution, all from
hashes of the word and the sample's number; with t = floor(ln weight / r + b) its rank is
ln c - r (t - b + 1), and the word of least rank, with its t, is the sample. Two documents have the
same sample with a probability equal to the generalised Jaccard similarity of their weights.

A sample is kept as one long: the rank, rounded to 2^-24, above 32 bits that name word and t. The least
long is the sample, so a plain minimum finds it and partial results can be combined.

Only DataFrame functions are used. Texts are moved once, by ranges of doc_id; all later steps need no
shuffle. Null texts count as empty; a document without words has an empty fingerprint, which is like
other empty ones (1.0) and unlike all others (0.0). Null ids come last in the order; rows that share an
id are ordered by a hash of their text, so equal rows are interchangeable. An empty table gives an
empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamtally.llm.common import partitions

SAMPLES = 32
WORD_BREAK = "[\\x20\\x09-\\x0D]+"
RANK_SCALE = float(1 << 24)
LOW_32 = 0xFFFFFFFF


def _uniform(h: Column, bit: int) -> Column:
    """Twenty bits of a hash as a number between 0 and 1."""
    return (F.shiftright(h, bit).bitwiseAND(F.lit((1 << 20) - 1)) + F.lit(0.5)) / F.lit(float(1 << 20))


def sample(word: Column, log_weight: Column, k: int) -> Column:
    """The k-th draw of a word (given by its hash) as rank and name in one long."""
    first, second = F.xxhash64(word, F.lit(2 * k)), F.xxhash64(word, F.lit(2 * k + 1))
    r = -F.log(_uniform(first, 0) * _uniform(first, 20))
    log_c = F.log(-F.log(_uniform(second, 0) * _uniform(second, 20)))
    b = _uniform(first, 40)
    t = F.floor(log_weight / r + b)
    rank = F.floor((log_c - r * (t - b + 1)) * F.lit(RANK_SCALE))
    return F.shiftleft(rank, 32).bitwiseOR(F.xxhash64(word, t).bitwiseAND(F.lit(LOW_32)))


def names(samples: list[Column]) -> Column:
    """The parts that are compared: array<long>, empty if there was no word."""
    return F.when(samples[0].isNull(), F.array().cast("array<long>")).otherwise(
        F.array(*[s.bitwiseAND(F.lit(LOW_32)) for s in samples])
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples of two arrays of `names`."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda n, x: n + x)
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(equal / F.greatest(F.size(a), F.size(b)).cast("double"))


def text_form(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def fingerprints(df: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """keys, fingerprint (array<long>) of rows (keys, text), one row per key."""
    words = df.select(*keys, F.explode(_words(F.coalesce("text", F.lit("")))).alias("word")).where("word is null or word <> ''")
    counted = words.groupBy(*keys, F.xxhash64("word").alias("h"), F.col("word").isNull().alias("head")).agg(F.count(F.lit(1)).alias("n"))
    drawn = [F.min(F.when(~F.col("head"), sample(F.col("h"), F.log("n"), k))).alias(f"m{k}") for k in range(samples)]
    return counted.groupBy(*keys).agg(*drawn).select(*keys, names([F.col(f"m{k}") for k in range(samples)]).alias("fingerprint"))


def _words(text: Column) -> Column:
    """A null, which stands for the document itself, and the words; empty strings have to be dropped."""
    return F.concat(F.array(F.lit(None).cast("string")), F.split(text, WORD_BREAK))


def _borders(df: DataFrame, n: int) -> list[float]:
    """n ranges of about equal row counts; any borders give right results."""
    found = df.approxQuantile("doc_id", [k / n for k in range(1, n)], 1 / (4 * n)) if n > 1 else []
    return sorted({float(b) for b in found})


def _range_of(doc_id: Column, borders: list[float]) -> Column:
    """Number of borders below the id, looked up in two steps; -1 for null."""
    if not borders:
        return F.when(doc_id.isNull(), -1).otherwise(0)
    step = math.isqrt(len(borders)) + 1
    parts = [borders[i : i + step] for i in range(0, len(borders), step)]
    below = lambda a: F.size(F.filter(a, lambda b: b < doc_id))
    part = F.greatest(below(F.array(*[F.lit(p[0]) for p in parts])), F.lit(1))
    inside = F.element_at(F.array(*[F.array(*map(F.lit, p)) for p in parts]), part)
    return F.when(doc_id.isNull(), -1).otherwise((part - 1) * step + below(inside))


def edited_fingerprints(df: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 2) code points replaced by as many of the next document.
    """
    tasks = 4 * partitions(df.sparkSession)
    base = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    placed = base.withColumn("range", _range_of(F.col("doc_id"), _borders(base.select("doc_id"), 2 * tasks)))
    heads = sorted(
        ((r["range"], r["head"]) for r in placed.groupBy("range").agg(F.max("doc_id").alias("head")).collect()), key=lambda x: x[0]
    )  # one row per range
    hosts = [(head, heads[(i + 1) % len(heads)][0]) for i, (_, head) in enumerate(heads)]
    invited = F.broadcast(df.sparkSession.createDataFrame(hosts, "head long, host int"))
    own = F.struct(F.col("range").alias("range"), F.lit(0).alias("guest"))
    visit = F.struct(F.col("host").alias("range"), F.lit(1).alias("guest"))
    seats = F.when(F.col("host").isNull(), F.array(own)).otherwise(F.array(own, visit))
    seated = placed.join(invited, F.col("doc_id").eqNullSafe(F.col("head")), "left").select(F.inline(seats), "doc_id", "text")

    order = Window.partitionBy("range").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    rows = seated.repartition(tasks, "range").select(
        "range", "guest", "doc_id", "text", F.row_number().over(order).alias("place"), F.lead("text").over(order).alias("next")
    )
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.coalesce("next", F.lit("")), F.lit(1), half))
    rows = rows.select("range", "place", "guest", "doc_id", "text", n.cast("long").alias("n_chars"), edited.alias("edited"))
    digest = F.sha2(F.col("edited"), 256)
    quarter = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"s{i}") for i in range(8)]
    rows = rows.select("range", "place", "guest", "doc_id", "n_chars", "text", "edited", *quarter)
    first = F.struct(F.lit(0).alias("version"), F.col("text").alias("body"))
    second = F.struct(F.lit(1).alias("version"), F.col("edited").alias("body"))
    told = ["guest", "doc_id", "n_chars", *[f"s{i}" for i in range(8)]]
    versions = rows.select("range", "place", *told, F.inline(F.when(F.col("guest") == 1, F.array(first)).otherwise(F.array(first, second))))
    words = versions.select("range", "place", "version", *told, F.explode(_words(F.col("body"))).alias("word")).where("word is null or word <> ''")

    # A document's own row (its word is null) carries what belongs to the document through both sums. A word's draws are
    # the same in both versions: outside of conditions, they are computed once for both; without a weight there is no sample.
    head = F.col("word").isNull()
    group = ["range", "place"]
    counts = [F.count(F.when(F.col("version") == v, 1)).alias(f"n{v}") for v in (0, 1)]
    counted = words.groupBy(*group, F.when(~head, F.xxhash64("word")).alias("h")).agg(*counts, *[F.max(F.when(head, F.col(c))).alias(c) for c in told])
    weights = [F.when(F.col("h").isNotNull() & (F.col(f"n{v}") > 0), F.log(f"n{v}")).alias(f"w{v}") for v in (0, 1)]
    weighed = counted.select(*group, "h", *weights, *told)
    drawn = [F.min(sample(F.col("h"), F.col(f"w{v}"), k)).alias(f"m{v}_{k}") for k in range(samples) for v in (0, 1)]
    signed = weighed.groupBy(*group).agg(*drawn, *[F.max(c).alias(c) for c in told])
    sha = F.lower(F.concat(*[F.lpad(F.hex(f"s{i}"), 8, "0") for i in range(8)]))
    prints = [names([F.col(f"m{v}_{k}") for k in range(samples)]).alias(p) for v, p in enumerate(("print", "edited_print"))]
    signed = signed.select(*group, "guest", "doc_id", "n_chars", sha.alias("edited_sha256"), *prints)
    line = Window.partitionBy("range").orderBy("place")
    seen = signed.select("*", F.lead("print").over(line).alias("next_print")).where("guest = 0")
    return seen.select(
        "doc_id", "n_chars", "edited_sha256", text_form(F.col("print")).alias("fingerprint"), text_form(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"), likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
