"""The filter audit against applying all 120 orders document by document."""

import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from streamtally.llm import audit
from tests.llm import brute
from tests.llm.conftest import SCHEMA, SF

LABELS = "doc_id long, quality int, toxic int"


def fails(text):
    words = brute.WORD.findall(text)
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
    }


def audited(docs, labels):
    """docs: (doc_id, text, lang)."""
    rows = []
    smallest = {}
    for i, t, _ in docs:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in range(2))
    for i, t, lang in docs:
        f = {x for x, yes in fails(t or "").items() if yes}
        first = smallest.get(t or "")
        if first is not None and (i is None or first < i):
            f.add("E")
        rows.append((lang or "", f, i in good, i in toxic))
    out = []
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        shapley, steps = Counter(), []
        for order in permutations("ABCDE"):
            left = own
            for k, f in enumerate(order):
                here = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(here)
                failing = sum(f in r[1] for r in own)
                steps.append([part, "".join(order), k + 1, len(left), len(here), failing - len(here), sum(r[1] == {f} for r in own), sum(r[2] for r in here), sum(r[3] for r in here)])
        out += [(*s, shapley[s[1][s[2] - 1]]) for s in steps]
    return sorted(out)


def check(docs, labels):
    got = audit.audit(docs, labels)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    want = audited([tuple(r) for r in docs.select("doc_id", "text", "lang").collect()], [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    assert sorted(map(tuple, got.collect())) == want


def test_audit_of_documents(spark, docs):
    check(docs, spark.read.parquet(f"{SF}/labels.parquet"))


def test_audit_of_odd_rows(spark, odd, nulls, empty):
    labels = [(1, 1, 0), (1, 0, 1), (8, 0, 0), (15, None, 1), (None, 1, 1), (4, 1, 1), (-20, 1, None), (777, 1, 1)]
    labels = spark.createDataFrame(labels, LABELS).withColumns({"text": F.lit(""), "mask": F.lit(0), "part": F.lit("x")})
    check(odd.withColumns({"mask": F.lit(3), "good": F.lit(1), "part": F.lit("p"), "n": F.lit(1)}), labels)
    check(nulls, labels)
    check(nulls, labels.limit(0))
    assert audit.audit(empty, labels).count() == 0


def test_copies_in_several_parts(spark):
    rows = [(i, "same", ["en", "fr", None][i % 3], None, None) for i in range(3, 40)] + [(3, "same", "fr", None, None), (3, "same", "fr", None, None), (1, "SAME", "en", None, None)]
    check(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(i, 1, i % 2) for i in range(3, 20)], LABELS))


@pytest.mark.parametrize("worth", [[min(s, 1) for s in range(32)], [bin(s).count("1") ** 2 for s in range(32)], [(7 * s * s) % 11 for s in range(32)]])
def test_potential(spark, worth):
    """The recursion against marginal contributions over all orders."""
    worth[0] = 0
    game = spark.createDataFrame([("p", worth)], "part string, worth array<long>")
    got = {r["filter"]: r["shapley"] for r in audit.shapley(audit.potentials(game)).collect()}
    want = Counter()
    for order in permutations(range(5)):
        before = 0
        for f in order:
            want["ABCDE"[f]] += worth[before | 1 << f] - worth[before]
            before |= 1 << f
    assert got == {f: want[f] for f in "ABCDE"}
