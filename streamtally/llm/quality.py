"""Quality rules by distribution divergence: the character classes and the common words of a document,
as histograms, against those of its language, by Jensen-Shannon distance.

The references are counted over all rows, for every `lang` of at least REFERENCE_DOCS documents and
REFERENCE_WORDS words. The common words of a language without a list are its FREQUENT most frequent ones
in these rows. A document is held against the reference of its own `lang`; where that is null or has no
reference, the base rules decide alone and the distances are null. Distances of short texts are noise, so
each histogram is only judged from a least number of characters or words on, and the allowed distance of
words grows with the noise that is left. Null and empty texts have counts of 0 and fail the base rules.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamtally.llm.common import map_texts
from streamtally.llm.hashes import ASCII_WHITE, span_hashes

# Frequent words of these languages, those of others are counted; all other words are one class of their own.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach".split(),
    "en": "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which".split(),
    "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí porque".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec son aux d elle".split(),
}
SYMBOLS = "#*$%&|<>"

MIN_CHARS = 200  # characters other than white space from which the character classes are judged
MIN_WORDS = 50  # words from which the common words are judged
MAX_CHAR_DISTANCE = 0.29
MAX_WORD_DISTANCE = 0.2
FREQUENT = 30  # most frequent words of a language without a list
REFERENCE_DOCS, REFERENCE_WORDS = 10, 2000  # with words, of one `lang`, from which it has a reference
NOISE_SHARE = 0.5  # of the expected distance of a sample of that many words that is allowed on top
PIECE = 1 << 20

# Character classes: lower-case, upper-case and other letters, digits, sentence marks, other punctuation, symbols, rest.
CLASSES = 8


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By code point: class (CLASSES: white space), lower-case letter or 0, random number of the code point, of the letter."""
    kinds = {"Ll": 0, "Lu": 1, "Lt": 1, "Lm": 2, "Lo": 2, "Mn": 2, "Mc": 2, "Nd": 3, "Nl": 3, "No": 3}
    n = 0x110000
    kind, lower = np.full(n, CLASSES - 1, np.uint8), np.zeros(n, np.uint32)
    for c in range(n):
        category = unicodedata.category(ch := chr(c))
        if category in kinds:
            kind[c] = kinds[category]
            if kind[c] < 3:
                lower[c] = ord(low) if len(low := ch.lower()) == 1 else c
        elif category[0] == "P":
            kind[c] = 4 if ch in ".,;:'\"-?" else 5
        elif category[0] == "S":
            kind[c] = 6
        elif category[0] == "Z" or c in ASCII_WHITE:
            kind[c] = CLASSES
    noise = np.random.default_rng(11).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return kind, lower, noise, np.where(lower > 0, noise[lower], 0)


def word_hash(word: str) -> int:
    """As `Counts.common` has it for this word."""
    return int(measure([word]).letters[0])


@dataclass
class Counts:
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    classes: np.ndarray  # texts x CLASSES
    letters: np.ndarray  # per word: hash of its lower-cased letters
    owner: np.ndarray  # per word: its text


def measure(texts: list[str | None]) -> Counts:
    n = len(texts)
    kind, _, noise, letter_noise = tables()
    cps = np.frombuffer(" ".join(t or "" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t or "") for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64)
    text_of = np.repeat(np.arange(n), lengths + 1)[: len(cps)]

    classes = np.bincount(text_of * (CLASSES + 1) + kind[cps], minlength=n * (CLASSES + 1)).reshape(n, -1)[:, :CLASSES]
    white = np.isin(cps, np.array(ASCII_WHITE, np.uint32))
    inside = np.concatenate([[False], ~white, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    owner = text_of[start] if len(start) else np.zeros(0, np.int64)
    symbols = np.isin(cps, np.array([ord(c) for c in SYMBOLS], np.uint32))

    per_text = lambda mask: np.bincount(text_of[mask], minlength=n)
    exact = span_hashes(noise[cps], start, end)
    is_letter = letter_noise[cps] > 0
    rank = np.concatenate([[0], np.cumsum(is_letter)])
    letters = span_hashes(letter_noise[cps], start, end, rank)

    repeat = np.zeros(len(start), bool)
    if len(start) > 2:
        same = owner[:-2] == owner[2:]
        key = exact[:-2] * np.uint64(0x2545F4914F6CDD1D) + exact[1:-1] * np.uint64(0x9FB21C651E98DF25) + exact[2:] * np.uint64(0xD6E8FEB86659FD93)
        key = (key ^ (key >> np.uint64(29))) + owner[:-2].astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
        at = np.flatnonzero(same)
        order = at[np.argsort(key[at], kind="stable")]
        equal = np.concatenate([[False], key[order][1:] == key[order][:-1], [False]])
        twice = order[equal[: len(order)] | equal[1 : len(order) + 1]]
        for k in range(3):
            repeat[twice + k] = True

    dup = np.zeros(n, np.int64)
    for i, t in enumerate(texts):
        if t and "\n" in t:
            lines = [x for x in t.split("\n") if x.strip(" \t\n\v\f\r")]
            dup[i] = len(lines) - len(set(lines))
    return Counts(
        np.bincount(owner, minlength=n), lengths - (per_text(white) - (np.arange(n) < n - 1)), per_text(symbols), dup,
        np.bincount(owner[repeat], minlength=n), classes, letters, owner,
    )


@lru_cache(maxsize=1)
def listed() -> dict[str, np.ndarray]:
    """Hashes of the common words of each language that has a list, in its order."""
    return {x: np.array([word_hash(w) for w in COMMON_WORDS[x]], np.uint64) for x in sorted(COMMON_WORDS)}


def word_classes(counts: Counts, common: np.ndarray) -> np.ndarray:
    """texts x classes of the words with these hashes (0: all others)."""
    n, width = len(counts.n_words), len(common) + 1
    if width == 1:
        return counts.n_words.reshape(n, 1)
    order = np.argsort(common, kind="stable")
    at = order[np.minimum(np.searchsorted(common, counts.letters, sorter=order), len(common) - 1)]
    slot = np.where(common[at] == counts.letters, at + 1, 0)
    return np.bincount(counts.owner * width + slot, minlength=n * width).reshape(n, width)


def histograms(counts: Counts, language: int) -> np.ndarray:
    """texts x classes of common words (0: all others) in this language, by its place among those with a list."""
    return word_classes(counts, listed()[sorted(COMMON_WORDS)[language]])


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (0 to 1, base 2) of each row of counts p from the counts q."""
    p = p / np.maximum(p.sum(axis=-1, keepdims=True), 1)
    q = q / max(q.sum(), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=-1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=-1)
    return np.sqrt(np.clip((left + right) / 2, 0, 1))


@dataclass(frozen=True)
class Reference:
    classes: np.ndarray
    common: np.ndarray  # hashes of the common words
    words: np.ndarray  # counts of all others and of each of these


References = dict[str, Reference]
CLASS, DOCS, WORDS, WORD = range(4)  # what a count is of; all but DOCS and WORDS have a key


def counted(df: DataFrame) -> DataFrame:
    """lang, kind, key, n over all rows (text, lang) with a lang: character classes, documents and words, and each
    word by its hash (of a language with a list only the words in it)."""

    def make():
        def work(batch):
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            found: list[tuple[str, int, np.ndarray, np.ndarray]] = []
            at = 0
            for part in sized(texts):
                counts = measure(part)
                names, code = np.unique(np.array(langs[at : at + len(part)], object), return_inverse=True)
                at += len(part)
                order = np.argsort(code[counts.owner], kind="stable")
                cuts = np.searchsorted(code[counts.owner][order], np.arange(len(names) + 1))
                for c, name in enumerate(names):
                    own = code == c
                    hashes, n = np.unique(counts.letters[order[cuts[c] : cuts[c + 1]]], return_counts=True)
                    # Words without a letter have no hash and are nobody's common word.
                    kept = np.isin(hashes, listed()[name]) if name in listed() else hashes != 0
                    found.append((name, CLASS, np.arange(CLASSES), counts.classes[own].sum(axis=0)))
                    found.append((name, DOCS, np.zeros(1, np.int64), np.array([(own & (counts.n_words > 0)).sum()])))
                    found.append((name, WORDS, np.zeros(1, np.int64), np.array([counts.n_words[own].sum()])))
                    found.append((name, WORD, hashes[kept].view(np.int64), n[kept]))
            sizes = [len(x[2]) for x in found]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array([x[0] for x in found], object), sizes), pa.string()),
                    pa.array(np.repeat(np.array([x[1] for x in found]), sizes), pa.int32()),
                    pa.array(np.concatenate([x[2] for x in found]), pa.int64()),
                    pa.array(np.concatenate([x[3] for x in found]), pa.int64()),
                ],
                ["lang", "kind", "key", "n"],
            )

        return work

    rows = map_texts(df.where("lang is not null"), ["text", "lang"], make, "lang string, kind int, key long, n long")
    return rows.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))


def at_least(kind: int, n: int):
    return lambda c: (c["kind"] == kind) & (c["n"] >= n)


def references(df: DataFrame) -> References:
    """Character classes and common words of each language that has enough documents, over all rows (text, lang)."""
    most = max(FREQUENT, CLASSES, *map(len, COMMON_WORDS.values()))
    rank = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "key"))
    top = counted(df).withColumn("rank", rank).where(F.col("rank") <= most)
    found = top.groupBy("lang").agg(F.collect_list(F.struct("kind", "key", "n")).alias("counts"))
    docs, words = (F.exists("counts", at_least(*x)) for x in ((DOCS, REFERENCE_DOCS), (WORDS, REFERENCE_WORDS)))
    out: References = {}
    for lang, rows in found.where(docs & words).collect():  # some forty numbers a language
        by_kind = {k: {r["key"]: r["n"] for r in rows if r["kind"] == k} for k in (CLASS, WORDS, WORD)}
        own = by_kind[WORD]
        frequent = sorted(own, key=lambda h: (-own[h], h))[:FREQUENT]
        common = listed()[lang] if lang in listed() else np.array(frequent, np.int64).view(np.uint64)
        each = [own.get(h, 0) for h in common.view(np.int64).tolist()]
        out[lang] = Reference(
            np.array([by_kind[CLASS].get(c, 0) for c in range(CLASSES)]), common, np.array([by_kind[WORDS][0] - sum(each), *each])
        )
    return out


def sized(texts: list[str | None]) -> list[list[str | None]]:
    """The texts in runs of about PIECE characters."""
    parts, size = [[]], 0
    for t in texts:
        if size > PIECE:
            parts.append([])
            size = 0
        parts[-1].append(t)
        size += len(t or "")
    return parts if texts else []


def judge(texts: list[str | None], langs: list[str | None], refs: References) -> dict[str, np.ndarray]:
    counts = measure(texts)
    n = len(texts)
    chars, words = np.full(n, np.nan), np.full(n, np.nan)  # without a reference: not a number, never too far
    held = np.array([x if x in refs else None for x in langs], object)
    for lang in sorted({x for x in held if x is not None}):
        own, ref = held == lang, refs[lang]
        chars[own] = distance(counts.classes[own], ref.classes)
        place = np.cumsum(own) - 1
        its = own[counts.owner]
        part = Counts(*[x[own] for x in (counts.n_words, counts.word_chars, counts.n_symbols, counts.n_dup_lines, counts.n_repeat_words, counts.classes)],
                      counts.letters[its], place[counts.owner[its]])
        words[own] = distance(word_classes(part, ref.common), ref.words)
    noise = np.sqrt(max(FREQUENT, *map(len, COMMON_WORDS.values())) / (8 * np.log(2) * np.maximum(counts.n_words, 1)))
    odd_chars = (counts.classes.sum(axis=1) >= MIN_CHARS) & (chars > MAX_CHAR_DISTANCE)
    odd_words = (counts.n_words >= MIN_WORDS) & (words > MAX_WORD_DISTANCE + NOISE_SHARE * noise)
    base_failed = (counts.n_words < 50) | (100 * counts.n_repeat_words > 50 * counts.n_words)
    return {
        "n_words": counts.n_words, "word_chars": counts.word_chars, "n_symbols": counts.n_symbols,
        "n_dup_lines": counts.n_dup_lines, "n_repeat_words": counts.n_repeat_words, "base_failed": base_failed,
        "kept": ~base_failed & ~odd_chars & ~odd_words, "char_distance": chars, "word_distance": words,
    }


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, char_distance double, word_distance double"
)


def rate(df: DataFrame, refs: References) -> DataFrame:
    """Counts, distances and verdict of each row of (doc_id, text, lang)."""

    def make():
        def work(batch):
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            parts, at = [], 0
            for part in sized(texts):
                parts.append(judge(part, langs[at : at + len(part)], refs))
                at += len(part)
            columns = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, from_pandas=True) for c in columns.values()]], ["doc_id", *columns])

        return work

    return map_texts(df, ["doc_id", "text", "lang"], make, SCHEMA)


def accepted(df: DataFrame, refs: References) -> DataFrame:
    """The rows that are kept, all columns as they are."""

    def make():
        def work(batch):
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            keep, at = [], 0
            for part in sized(texts):
                keep.append(judge(part, langs[at : at + len(part)], refs)["kept"])
                at += len(part)
            return batch.filter(pa.array(np.concatenate(keep)))

        return work

    return map_texts(df, df.columns, make, df.schema)
