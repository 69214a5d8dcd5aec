"""URL filter: rules by host and path, and gradient-boosted trees on lexical features for the rest.

Features and predictions are column expressions. The trees are fitted on the driver, on about
`TRAINING_ROWS` labelled rows at most: those whose hash of id and url lies below the cut-off that the number of
labelled rows gives, so every task sends its share only and the sample does not depend on the order of the rows.
Suffix statistics are shares of blocked rows by the host's suffix, the path's first segment, and both; in
training a row's shares come from the other folds, never from its own label. A null url, or one without `://`, has an empty host and path, fits
no rule and is judged by its features like any other (all counts 0 for null). Equal urls get equal
verdicts. Without labelled rows of both kinds the trees allow everything.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAINING_ROWS = 20_000
ROUNDS = 30
DEPTH = 3
SHRINKAGE = 0.2
LEAST_ROWS = 20  # in a leaf
BORDERS = 32  # tried per feature
SUFFIX_PRIOR = 10.0  # rows by which a suffix's share is drawn to the overall share
FOLDS = 5


@dataclass(frozen=True)
class Rule:
    host: str  # without port, lower case
    path: str  # starts with /
    verdict: str  # allow or block

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def match_rules(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):  # a longer one overrides
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def suffix(host: Column) -> Column:
    """The last two labels of the host."""
    return F.regexp_extract(host, r"([^.]*\.?[^.]*)$", 1)


def segment(path: Column) -> Column:
    """The path's first segment with what follows up to its first character: `/en/1` of `/en/123`, `/x` of `/x`."""
    return F.regexp_extract(path, r"(?s)^(/[^/]*(?:/.)?)", 1)


# Suffix statistics: each has a name, a key and an own table of shares.
def keys_of(host: Column, path: Column) -> dict[str, Column]:
    first = F.regexp_extract(path, r"(?s)^(/[^/]*)", 1)
    return {
        "suffix_share": suffix(host),
        "segment_share": first,
        "place_share": F.concat(suffix(host), first),
        "deep_share": F.concat(suffix(host), segment(path)),
    }


SHARES = ["suffix_share", "segment_share", "place_share", "deep_share"]


def features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    u = F.coalesce(url, F.lit(""))
    n = F.greatest(F.length(u), F.lit(1)).cast("double")
    query = F.regexp_extract(u, r"(?s)\?([^#]*)", 1)

    def left(pattern: str, text: Column) -> Column:
        return F.length(F.regexp_replace(text, pattern, "")).cast("double")

    chars = F.split(u, "")
    entropy = F.aggregate(
        F.array_distinct(chars),
        F.lit(0.0),
        lambda total, c: total
        + F.when(F.length(c) == 0, 0.0).otherwise(-((n - F.length(F.replace(u, c))) / n) * F.log2((n - F.length(F.replace(u, c))) / n)),
    )
    return {
        "length": F.length(u).cast("double"),
        "host_length": F.length(host).cast("double"),
        "host_labels": left(r"[^.]", host),
        "host_hyphens": left(r"[^-]", host),
        "path_length": F.length(path).cast("double"),
        "depth": left(r"[^/]", path),
        "digit_ratio": left(r"[^0-9]", u) / n,
        "entropy": entropy,
        "parameters": F.when(F.length(query) == 0, 0.0).otherwise(left("[^&]", query) + 1),
        "extension": F.length(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)).cast("double"),
        "secure": F.when(u.startswith("https"), 1.0).otherwise(0.0),
    }


FEATURES = [
    "length", "host_length", "host_labels", "host_hyphens", "path_length", "depth", "digit_ratio", "entropy",
    "parameters", "extension", "secure", *SHARES,
]


@dataclass(frozen=True)
class Split:
    feature: int
    border: float  # left: at most
    left: Split | float
    right: Split | float


@dataclass(frozen=True)
class Model:
    start: float
    trees: tuple[Split | float, ...]
    shares: dict[str, dict[str, float]]  # of each of SHARES, by key
    prior: float


def _tree(x: np.ndarray, gradient: np.ndarray, weight: np.ndarray, borders: list[np.ndarray], depth: int) -> Split | float:
    """Greedy by second-order gain; a leaf is the Newton step."""
    g, h = gradient.sum(), weight.sum()
    best = (1e-6, None, None)
    for f in range(x.shape[1]) if depth else []:
        for b in borders[f]:
            left = x[:, f] <= b
            k = int(left.sum())
            if LEAST_ROWS <= k <= len(x) - LEAST_ROWS:
                gl, hl = gradient[left].sum(), weight[left].sum()
                gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                if gain > best[0]:
                    best = (gain, f, float(b))
    _, f, b = best
    if f is None:
        return float(SHRINKAGE * g / (h + 1))
    left = x[:, f] <= b
    return Split(
        f, b,
        _tree(x[left], gradient[left], weight[left], borders, depth - 1),
        _tree(x[~left], gradient[~left], weight[~left], borders, depth - 1),
    )


def _value(tree: Split | float, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, Split):
        return np.full(len(x), tree)
    return np.where(x[:, tree.feature] <= tree.border, _value(tree.left, x), _value(tree.right, x))


def fit_trees(x: np.ndarray, blocked: np.ndarray) -> tuple[float, tuple[Split | float, ...]]:
    share = np.clip(blocked.mean(), 1e-6, 1 - 1e-6) if len(blocked) else 1e-6
    start = float(np.log(share / (1 - share)))
    borders = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BORDERS + 1)[:-1])) for f in range(x.shape[1])]
    score, trees = np.full(len(x), start), []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        tree = _tree(x, blocked - p, p * (1 - p), borders, DEPTH)
        trees.append(tree)
        score += _value(tree, x)
    return start, tuple(trees)


def _prepared(df: DataFrame, id_column: str, rules: list[Rule]) -> DataFrame:
    host, path = host_and_path(F.col("url"))
    placed = df.select(F.col(id_column).alias("id"), "url", host.alias("host"), path.alias("path"))
    rule, verdict = match_rules(F.col("host"), F.col("path"), rules)
    keys = [k.alias(f"{n}_key") for n, k in keys_of(F.col("host"), F.col("path")).items()]
    return placed.select("*", rule.alias("rule"), verdict.alias("known"), *keys)


def train(df: DataFrame, id_column: str = "page_id", rules: list[Rule] | None = None, label: str | None = None) -> Model:
    """From rows with a label: a column of allow/block, or else the verdicts of the rules."""
    base = _prepared(df.drop("known") if label else df, id_column, rules or [])
    if label:
        labelled = df.select(F.col(id_column).alias("id"), F.col("url"), F.col(label).alias("_label"))
        host, path = host_and_path(F.col("url"))
        placed = labelled.select("id", "url", host.alias("host"), path.alias("path"), F.col("_label").alias("known"))
        base = placed.select("*", *[k.alias(f"{n}_key") for n, k in keys_of(F.col("host"), F.col("path")).items()])
    labelled = base.where(F.col("known").isNotNull())
    n = labelled.count()
    chosen = labelled
    if n > TRAINING_ROWS:
        cut = int(TRAINING_ROWS / n * (1 << 62))
        chosen = labelled.where(F.shiftrightunsigned(F.xxhash64("id", "url"), 2) < cut)
    by_name = features(F.col("url"), F.col("host"), F.col("path"))
    # Copies of a row have one hash; folded, they cannot swell the sample.
    rows = chosen.select("id", "url", "known", *[f"{s}_key" for s in SHARES], *[c.alias(f) for f, c in by_name.items()]).distinct().collect()
    rows.sort(key=lambda r: (r["id"] is None, r["id"], r["url"] or ""))
    blocked = np.array([r["known"] == "block" for r in rows], float)
    prior = float(blocked.mean()) if len(rows) else 0.0
    if len(rows) < 2 * LEAST_ROWS or prior in (0.0, 1.0):
        return Model(-1.0, (), {s: {} for s in SHARES}, prior)
    x = np.array([[r[f] for f in FEATURES[: -len(SHARES)]] for r in rows], float)
    fold = np.arange(len(rows)) % FOLDS
    shares, columns = {}, []
    for s in SHARES:
        names, key = np.unique(np.array([r[f"{s}_key"] for r in rows], object).astype(str), return_inverse=True)
        hits, seen = np.zeros((len(names), FOLDS)), np.zeros((len(names), FOLDS))
        np.add.at(hits, (key, fold), blocked)
        np.add.at(seen, (key, fold), 1)
        smooth = lambda h, m: (h + SUFFIX_PRIOR * prior) / (m + SUFFIX_PRIOR)
        columns.append(smooth(hits.sum(axis=1)[key] - hits[key, fold], seen.sum(axis=1)[key] - seen[key, fold]))
        shares[s] = dict(zip(names.tolist(), smooth(hits.sum(axis=1), seen.sum(axis=1)).tolist(), strict=True))
    start, trees = fit_trees(np.column_stack([x, *columns]), blocked)
    return Model(start, trees, shares, prior)


def score(model: Model, values: list[Column]) -> Column:
    """Log odds of block."""

    def walk(tree: Split | float) -> Column:
        if not isinstance(tree, Split):
            return F.lit(tree)
        return F.when(values[tree.feature] <= tree.border, walk(tree.left)).otherwise(walk(tree.right))

    total = F.lit(model.start)
    for tree in model.trees:
        total = total + walk(tree)
    return total


def judge(df: DataFrame, model: Model, rules: list[Rule], id_column: str = "page_id") -> DataFrame:
    """id, host, path, rule, verdict, block_odds (log odds by the trees); one row per row of (id, url)."""
    placed = _prepared(df, id_column, rules)
    by_name = features(F.col("url"), F.col("host"), F.col("path"))
    for name in SHARES:
        if model.shares[name]:
            known = df.sparkSession.createDataFrame(list(model.shares[name].items()), f"{name}_key string, {name} double")
            placed = placed.join(F.broadcast(known), f"{name}_key", "left")  # keys of the training rows at most
        else:
            placed = placed.withColumn(name, F.lit(None).cast("double"))
    shares = [F.coalesce(name, F.lit(model.prior)).alias(name) for name in SHARES]
    measured = placed.select("id", "host", "path", "rule", "known", *[c.alias(n) for n, c in by_name.items()], *shares)
    odds = score(model, [F.col(f) for f in FEATURES])
    verdict = F.coalesce("known", F.when(F.col("odds") > 0, "block").otherwise("allow"))
    scored = measured.select("id", "host", "path", "rule", "known", odds.alias("odds"))
    return scored.select(F.col("id").alias(id_column), "host", "path", "rule", verdict.alias("verdict"), F.col("odds").alias("block_odds"))
