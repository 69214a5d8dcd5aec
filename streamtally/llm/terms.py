"""Words of letters and digits, with A-Z in lower case: their places and hashes, for many texts at once.

A word is a maximal run of 0-9, A-Z, a-z and characters beyond ASCII; only A-Z are lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from streamtally.llm.common import text_batches
from streamtally.llm.hashes import byte_noise, mixed, span_hashes

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"  # in text whose A-Z are lower-cased
BATCH_BYTES = 2 << 20

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_inside = np.zeros(256, bool)
_inside[48:58] = _inside[65:91] = _inside[97:123] = _inside[128:] = True


def words_column(text: Column) -> Column:
    """The words of a text column as an array; none for null."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BREAK)
    return F.filter(parts, lambda w: w != "")


@dataclass
class Words:
    data: np.ndarray  # lower-cased bytes of all texts
    start: np.ndarray  # of each word in data
    end: np.ndarray
    first: np.ndarray  # number of the first word of each text, and the number of words
    offsets: np.ndarray  # of each text in data, and the end

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        return mixed(span_hashes(byte_noise()[self.data], self.start, self.end))

    def joined(self, first: int, n: int) -> bytes:
        """n words from this one on, with one space between them."""
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(self.start[first : first + n], self.end[first : first + n], strict=True))


def words(texts: pa.Array) -> Words:
    """Of a string array; a null has no words."""
    wide = pa.types.is_large_string(texts.type)
    _, places, content = texts.buffers()
    n = len(texts)
    offsets = np.zeros(1, np.int64)
    if n:
        offsets = np.frombuffer(places, np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(content, np.uint8)[offsets[0] : offsets[-1]] if content is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    inside = np.zeros(len(raw) + 1, bool)
    inside[:-1] = _inside[raw]
    before = np.zeros(len(raw) + 1, bool)
    before[1:] = inside[:-1]
    border = np.zeros(len(raw) + 1, bool)
    border[offsets] = True
    start = np.flatnonzero(inside & (~before | border))
    end = np.flatnonzero(before & (~inside | border))
    return Words(_lower[raw], start, end, np.searchsorted(start, offsets).astype(np.int64), offsets)


def small_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return text_batches(batches, BATCH_BYTES)


class HashSet:
    """Membership in a set of 64-bit hashes: a table of bits first, then a search among the sorted hashes."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.unique(hashes)
        self.shift = np.uint64(64 - max(10, min(27, int(len(self.sorted)).bit_length() + 4)))
        self.bits = np.zeros(1 << (64 - int(self.shift)), bool)
        self.bits[self.sorted >> self.shift] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of these are in the set, and their places among the sorted."""
        if not len(self.sorted):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        maybe = np.flatnonzero(self.bits[hashes >> self.shift])
        at = np.minimum(np.searchsorted(self.sorted, hashes[maybe]), len(self.sorted) - 1)
        found = self.sorted[at] == hashes[maybe]
        return maybe[found], at[found]
