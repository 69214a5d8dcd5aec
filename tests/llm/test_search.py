"""Ranked search against scoring every document for every query."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from streamtally.llm import search
from tests.llm.conftest import SCHEMA, SF

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
ITEMS = "item_id long, text string"


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in TERM.findall(text or "")]


def ranked(docs, items, top=20):
    """(item_id, rank, doc_id, score), by the formula."""
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, total = sum(n > 0 for _, _, n in held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for doc, counts, n in held:
            m = 100 - 25 + (25 * n * n_docs) // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + 12 * m))
                for t in terms(text)
                if counts[t]
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, k + 1, doc, -s) for k, (s, _, _, doc) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def found(docs, items, **kw):
    got = search.search(docs, items, **kw)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=str)


def plain(df, key):
    return [(r[key], r["text"]) for r in df.select(key, "text").collect()]


@pytest.mark.parametrize("limits", [{}, {"unit_postings": 3000, "query_terms_limit": 300}])
def test_search_of_documents(spark, docs, limits):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert found(docs, items, **limits) == ranked(plain(docs, "doc_id"), plain(items, "item_id"))


@pytest.mark.parametrize("top", [1, 3, 100])
def test_search_of_odd_rows(spark, odd, top):
    asked = [
        (1, "The HOUSE of été"), (1, "prose end und und und"), (2, None), (3, ""), (4, "!!! ---"), (5, "nowhere"), (6, "x" * 70_000),
        (None, "passage tail"), (7, "one two"), (7, "one two"), (8, "İstanbul ß"), (9, "line one two same words here again ab a b"),
    ]
    items = spark.createDataFrame(asked, ITEMS).withColumns({c: F.lit(1) for c in ["term", "query", "n", "doc_id"]})
    want = ranked(plain(odd, "doc_id"), asked, top)
    assert found(odd, items, top=top) == want
    assert found(odd, items, top=top, unit_postings=20, query_terms_limit=5) == want


def test_ties_repeated_rows_and_rows_without_ids(spark, nulls):
    asked = [(1, "a b x")]
    items = spark.createDataFrame(asked, ITEMS)
    assert found(nulls, items) == ranked(plain(nulls, "doc_id"), asked)
    copies = [(i, "same text here", None, None, None) for i in range(900)] + [(1000 + i, f"other {i} text", None, None, None) for i in range(300)]
    df = spark.createDataFrame(copies, SCHEMA)
    asked = [(1, "same here"), (2, "other text 7")]
    assert found(df, spark.createDataFrame(asked, ITEMS), unit_postings=500) == ranked(plain(df, "doc_id"), asked)


def test_search_of_empty_tables(spark, empty, docs):
    items = spark.createDataFrame([(1, "the of")], ITEMS)
    assert found(empty, items) == []
    assert found(docs, spark.createDataFrame([], ITEMS)) == []
    assert found(spark.createDataFrame([(1, "alpha", None, None, None)], SCHEMA), items) == []


def unit(rng, docs, size):
    """A unit of twenty kinds of documents, each with terms of its own, and some that all share."""
    rows = [np.unique(np.concatenate([rng.integers(0, 10, 6), 10 + 20 * (d % 20) + rng.integers(0, 20, 6)])) for d in range(docs)]
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    term = np.concatenate(rows)
    tf = rng.integers(1, 9, len(term))
    df = np.bincount(term, minlength=size)
    weight = search.weights(docs, df)
    asked = [np.unique(rng.choice(rows[q])) for q in range(0, docs, 40)] + [rows[q] for q in range(0, docs, 30)]
    first = np.concatenate([[0], np.cumsum([len(a) for a in asked])])
    ordered = np.concatenate([a[np.argsort(-weight[a], kind="stable")] for a in asked])
    model = search.Model(docs, int(tf.sum()), len(term), weight, first, ordered, weight[ordered], np.ones(len(asked), np.int64), 5)
    return search.Unit(model, np.arange(docs), np.add.reduceat(tf, ends[:-1]), ends, term, tf), model, asked


def test_blocks_hold_their_summaries_and_are_skipped():
    own, model, asked = unit(np.random.default_rng(3), 1200, 410)
    results = {q: (docs, scores) for q, docs, scores in own.search()}
    dense = np.zeros((1200, 410), np.int64)
    for d in range(1200):
        at = slice(own.ends[d], own.ends[d + 1])
        dense[d, own.term[at]] = own.value[at]
    for q, terms_of in enumerate(asked):
        scores = dense[:, terms_of] @ model.weight[terms_of]
        best = np.lexsort((np.arange(1200), -scores))[:5]
        best = best[scores[best] > 0]
        assert sorted(results[q][0].tolist()) == sorted(best.tolist())
        assert sorted(results[q][1].tolist()) == sorted(scores[best].tolist())
    pairs = sum(int((dense[:, t].any(axis=1)).sum()) for t in asked)
    assert own.read > 0 and own.skipped > 0 and own.scored < pairs / 3
    for t, (split, places, of, highest) in own.blocks.items():
        assert sorted(np.concatenate(split).tolist()) == np.flatnonzero(dense[:, t]).tolist()
        for b, docs in enumerate(split):
            summary = np.zeros(410, np.int64)
            summary[of[places[b] : places[b + 1]]] = highest[places[b] : places[b + 1]]
            assert (summary == dense[docs].max(axis=0)).all()
    long = max(own.blocks.values(), key=lambda x: sum(map(len, x[0])))
    assert len(long[0]) > 1


def test_floor_keeps_ties():
    """A floor equal to the score of the last place loses nobody."""
    own, model, _ = unit(np.random.default_rng(4), 300, 410)
    want = {q: (sorted(own.ids[d].tolist()), sorted(s.tolist())) for q, d, s in own.search()}
    for q, (_, scores) in want.items():
        model.floor[q] = scores[0]
    again, _, _ = unit(np.random.default_rng(4), 300, 410)
    again.model = model
    assert {q: (sorted(again.ids[d].tolist()), sorted(s.tolist())) for q, d, s in again.search()} == want
