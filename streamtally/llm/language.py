"""Language identification by error-correcting output codes.

Each learned language has a codeword of +1/-1 bits. For each bit one binary classifier on hashed
letter trigrams (naive Bayes with equal weight for each language of a side) says which side a text
is on; the language whose codeword loses least against the bits' margins, bits weighted by how well
their sides separate, is the prediction. A small distance to the runner-up flags the text as ambiguous.

The classifiers are fitted on the trigram counts of all labelled rows, summed on the cluster; only
languages x buckets counts reach the driver. Texts that are null or have no letter are `und` with
score 0. Rows with a null label are not learned from. Without any label everything is `und`.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamtally.llm.common import map_texts

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
SMOOTHING = 0.5  # added to each bucket's count, per language
EVIDENCE = 48  # trigrams that count at most: margins of long texts are means of so many
AMBIGUOUS = 0.7  # least score of a prediction that is not flagged
PIECE = 2 << 20  # bytes handled at once

UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
_SPACED = bytes(b if chr(b).isalpha() or b >= 128 else 32 for b in range(256))


def _joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' lower-cased letters in UTF-8, all else as spaces, each text after two spaces; and where each starts."""
    parts = [b"  " + t.lower().encode().translate(_SPACED) if t else b"  " for t in texts]
    starts = np.zeros(len(parts), np.int64)
    np.cumsum([len(p) for p in parts[:-1]], out=starts[1:])
    return np.frombuffer(b"".join(parts) + b" ", np.uint8), starts


def _grams(data: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram around each byte a..b-1 (a >= 1), and whether that byte is a letter's."""
    mid = data[a:b]
    key = data[a - 1 : b - 1].astype(np.uint32) << 16
    key |= mid.astype(np.uint32) << 8
    key |= data[a + 1 : b + 1]
    key *= np.uint32(2654435761)
    key >>= np.uint32(32 - BUCKET_BITS)
    return key, mid != 32


def _pieces(data: np.ndarray, starts: np.ndarray):
    """(a, b, first text, offsets in the piece at which its texts begin)."""
    for a in range(1, len(data) - 1, PIECE):
        b = min(a + PIECE, len(data) - 1)
        first = max(int(np.searchsorted(starts, a, "right")) - 1, 0)
        last = int(np.searchsorted(starts, b, "left"))
        yield a, b, first, np.maximum(starts[first:last] - a, 0)


def count_grams(df: DataFrame) -> DataFrame:
    """lang, bucket, n over rows (text, lang), lang not null; each task adds up before the shuffle."""

    def run(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lang in sorted(set(langs)):
                rows = np.flatnonzero(langs == lang)
                total = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
                step = max(1, len(rows) * PIECE // max(batch.nbytes, PIECE))
                for k in range(0, len(rows), step):
                    data, starts = _joined(batch.column("text").take(pa.array(rows[k : k + step])).to_pylist())
                    for a, b, _, _ in _pieces(data, starts):
                        keys, valid = _grams(data, a, b)
                        total += np.bincount(keys[valid], minlength=BUCKETS)
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])],
                ["lang", "bucket", "n"],
            )

    counted = df.where(F.col("lang").isNotNull()).select("lang", "text").mapInArrow(run, "lang string, bucket int, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def codewords(n: int) -> np.ndarray:
    """n rows of +1/-1. Up to seven languages: every way to split them in two; beyond: random splits, a fixed seed."""
    if n < 2:
        return np.ones((n, 1), np.float64)
    if n <= 7:
        columns = [[1 if i == 0 or not (c >> (i - 1)) & 1 else -1 for i in range(n)] for c in range(1, 1 << (n - 1))]
        return np.array(columns, np.float64).T
    rng = np.random.default_rng(7)
    bits: list[np.ndarray] = []
    while len(bits) < math.ceil(10 * math.log2(n)):
        column = rng.permutation(np.where(np.arange(n) < n // 2, 1.0, -1.0))
        if not any(abs(column @ other) == n for other in bits):
            bits.append(column)
    return np.array(bits).T


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # bits x buckets: log odds of the +1 side
    trust: np.ndarray  # bits


def fit(counts: dict[str, np.ndarray]) -> Model:
    languages = tuple(sorted(counts))
    code = codewords(len(languages))
    share = np.array([(counts[x] + SMOOTHING) / (counts[x].sum() + SMOOTHING * BUCKETS) for x in languages])
    weights, trust = [], []
    for bit in code.T if len(languages) > 1 else []:
        plus, minus = share[bit > 0].mean(axis=0), share[bit < 0].mean(axis=0)
        weights.append(np.log(plus / minus))
        trust.append(((plus - minus) * weights[-1]).sum())
    if not weights:
        weights, trust = [np.zeros(BUCKETS)], [1.0]
    return Model(languages, code, np.array(weights, np.float32), np.array(trust) / np.sum(trust))


def learn(df: DataFrame) -> Model:
    """From all rows of (text, lang)."""
    counts: dict[str, np.ndarray] = {}
    for row in count_grams(df).toLocalIterator():  # languages x BUCKETS rows at most
        counts.setdefault(row["lang"], np.zeros(BUCKETS))[row["bucket"]] = row["n"]
    return fit(counts)


def judge(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and ambiguity of each text."""
    if not model.languages or not texts:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
    data, starts = _joined(texts)
    sums, n = np.zeros((len(model.weights), len(texts))), np.zeros(len(texts))
    for a, b, first, at in _pieces(data, starts):
        keys, valid = _grams(data, a, b)
        n[first : first + len(at)] += np.add.reduceat(valid, at, dtype=np.int64)
        for j, w in enumerate(model.weights):
            sums[j, first : first + len(at)] += np.add.reduceat(np.where(valid, w[keys], np.float32(0)), at, dtype=np.float64)
    margins = sums / np.maximum(n, 1) * np.minimum(n, EVIDENCE)
    # Logistic loss of each language's codeword, bits weighted.
    loss = np.array([(model.trust[:, None] * np.logaddexp(0, -c[:, None] * margins)).sum(axis=0) for c in model.code])
    best = loss.argmin(axis=0)
    score = 1 / np.exp(np.maximum(loss.min(axis=0) - loss, -700)).sum(axis=0)
    known = np.array([bool(t) and LETTER.search(t) is not None for t in texts])
    score = np.where(known, np.clip(score, 0, 1), 0.0)
    return [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)], score, score < AMBIGUOUS


def predict(df: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous; one row per row of (doc_id, text)."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # languages x buckets numbers

    def make():
        def work(batch):
            texts = batch.column("text").to_pylist()
            pred, score, ambiguous = [], [], []
            step = max(1, len(texts) * PIECE // max(batch.nbytes, PIECE))
            for k in range(0, len(texts), step):
                p, s, a = judge(shared.value, texts[k : k + step])
                pred += p
                score.append(s)
                ambiguous.append(a)
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(np.concatenate(score)), pa.array(np.concatenate(ambiguous))],
                ["doc_id", "lang_pred", "score", "ambiguous"],
            )

        return work

    return map_texts(
        df, ["doc_id", "text"], make, "doc_id long, lang_pred string, score double, ambiguous boolean"
    )


def settled(label: str | None, pred: str, ambiguous: bool, learned: frozenset[str]) -> str | None:
    """The language a row is given, or None if it is rejected (see `identified`)."""
    if pred == UNKNOWN or (ambiguous and label not in learned):
        return None
    return label if ambiguous else pred


def identified(df: DataFrame, model: Model) -> DataFrame:
    """The rows whose language can be told, with `lang` settled; all other columns as they are.

    A clear prediction decides: it fills a null label, replaces one that was never learned, and overrules a learned
    one that differs. Where the prediction is ambiguous, a learned label stands; without one the row is rejected.
    Rows whose text is null or has no letter are rejected.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index("lang")

    def make():
        learned = frozenset(shared.value.languages)

        def work(batch):
            texts, labels, given = batch.column("text").to_pylist(), batch.column("lang").to_pylist(), []
            step = max(1, len(texts) * PIECE // max(batch.nbytes, PIECE))
            for k in range(0, len(texts), step):
                pred, _, ambiguous = judge(shared.value, texts[k : k + step])
                given += [settled(x, p, bool(a), learned) for x, p, a in zip(labels[k : k + step], pred, ambiguous, strict=True)]
            columns = [pa.array(given, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            return pa.RecordBatch.from_arrays(columns, batch.schema.names).filter(pa.array([g is not None for g in given], pa.bool_()))

        return work

    return map_texts(df, df.columns, make, df.schema)
