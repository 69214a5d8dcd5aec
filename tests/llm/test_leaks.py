"""Benchmark decontamination against comparing all windows."""

import re

import pytest
from pyspark.sql import functions as F

from streamtally.llm import leaks
from tests.llm import brute
from tests.llm.conftest import SCHEMA, SF

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
ITEMS = "item_id long, text string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def contaminated(docs, items, size=10):
    """(doc_id, n_words, n_hit, n_items, digest, contaminated) and the texts without the hit words."""
    windows = {}
    for item, text in items:
        w = WORD.findall(lower(text))
        m = min(len(w), size)
        for k in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[k : k + m]), set()).add(item)
    sizes = sorted({len(w) for w in windows})
    rows, texts = [], []
    for doc, text in docs:
        places = list(WORD.finditer(lower(text)))
        w = [p[0] for p in places]
        hit, found = set(), set()
        for m in sizes:
            for k in range(len(w) - m + 1):
                if (got := windows.get(tuple(w[k : k + m]))) is not None:
                    hit.update(range(k, k + m))
                    found |= got
        ids = sorted(str(i) for i in found if i is not None)
        rows.append((doc, len(w), len(hit), len(ids), brute.sha(",".join(ids)), bool(hit)))
        gone = set()
        for k in hit:
            gone.update(range(places[k].start(), places[k].end()))
            if k + 1 in hit:
                gone.update(range(places[k].start(), places[k + 1].start()))
        texts.append((doc, text if text is None else "".join(c for p, c in enumerate(text) if p not in gone)))
    return sorted(rows, key=str), sorted(texts, key=str)


def plain(df, key):
    return [(r[key], r["text"]) for r in df.select(key, "text").collect()]


def check(docs, items, **kw):
    rows, texts = contaminated(plain(docs, "doc_id"), plain(items, "item_id"), kw.get("size", 10))
    assert sorted(map(tuple, leaks.contamination(docs, items, **kw).collect()), key=str) == rows
    cut = leaks.decontaminated(docs, items, "spans", **kw)
    assert cut.columns == docs.columns
    assert sorted(plain(cut, "doc_id"), key=str) == texts
    kept = leaks.decontaminated(docs, items, "documents", **kw)
    assert kept.columns == docs.columns
    want = [t for t, r in zip(sorted(plain(docs, "doc_id"), key=str), sorted(rows, key=str), strict=True) if not r[5]] if len({r[0] for r in rows}) == len(rows) else None
    assert want is None or sorted(plain(kept, "doc_id"), key=str) == want
    return rows


@pytest.mark.parametrize("limits", [{}, {"block": 400}, {"size": 3}])
def test_leaks_of_documents(spark, docs, limits):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = check(docs, items, **limits)
    assert any(r[5] for r in rows) and not all(r[5] for r in rows)


ASKED = [
    (1, "passage stands in several OF these documents, word for word, and is longer"), (1, "of these documents word for word"), (2, None), (3, ""), (4, "--- !"),
    (5, "Été"), (None, "one two"), (6, "one two"), (6, "one two"), (7, "ab " * 12), (8, "x" * 70_000), (10, "the of und the of und x x x x x"), (11, "a\x00b"), (12, "İstanbul ß"),
]


@pytest.mark.parametrize("block", [leaks.BLOCK, 3])
def test_leaks_of_odd_rows(spark, odd, nulls, empty, block):
    items = spark.createDataFrame(ASKED, ITEMS).withColumn("doc_id", F.lit(1))
    extra = odd.withColumns({c: F.lit("y") for c in ["n_words", "items", "runs", "clean", "digest", "hash", "item", "c1"]})
    check(extra, items, block=block)
    check(nulls, items, block=block)
    assert leaks.contamination(empty, items, block=block).count() == 0


def test_empty_benchmark(spark, docs):
    rows = check(docs, spark.createDataFrame([], ITEMS))
    assert not any(r[5] for r in rows)


def test_equal_hashes_are_not_hits(spark, monkeypatch):
    """With every window in one hash, only equal words hit."""
    import numpy as np

    items = spark.createDataFrame([(1, "a b c"), (2, "d e f"), (3, "d e f")], ITEMS)
    table = leaks.windows(items, 3).toArrow()
    flat = table.set_column(table.column_names.index("hash"), "hash", [np.zeros(table.num_rows, np.int64)])
    monkeypatch.setattr(leaks, "_window_hashes", lambda hashes, n: np.zeros(len(hashes), np.uint64))
    import pyarrow as pa

    counts, hits, found, runs, _ = leaks.WindowSet(flat).scan(pa.array(["x a b c y", "a b d", "q D, e-f.", None]), False)
    assert counts.to_pylist() == [5, 3, 4, 0] and hits.to_pylist() == [3, 0, 3, 0]
    assert found.to_pylist() == [["1"], [], ["2", "3"], []]
    assert runs.to_pylist()[2] == [{"first": 1, "last": 3, "start": 2, "end": 8}]


def test_a_passage_in_a_third_of_the_rows(spark):
    passage = "each of these ten or more words is in the benchmark as it is"
    rows = [(i, f"w{i} {passage} z{i}" if i % 3 == 0 else f"clean {i} " * 20, None, None, None) for i in range(900)]
    check(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(k, f"q{k} {passage} r{k}") for k in range(30)], ITEMS))
