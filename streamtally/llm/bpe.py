"""Byte-level BPE: encoding by a priority queue of merge ranks over a doubly linked list of
symbols, decoding by concatenating the vocabulary's strings.

Runs of the text between single spaces are encoded once and kept in a bounded table per Python
worker; what a run encodes to does not depend on its surroundings (see `UNSAFE`). A null text
counts as empty and has no tokens.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from functools import cached_property, lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from streamtally.llm.common import map_texts

# The pre-tokenizer's pattern and Unicode's white space.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SPACE = "".join(map(chr, WHITE))
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
# A space between other white space (or at the very end after some): there the text cannot be cut at its spaces.
UNSAFE = re.compile(rf"[{SPACE}] (?:[{SPACE}]|\Z)")

MAX_CACHED = 250_000
MAX_TRACED = 500_000  # about 150 MB a worker, and as much for the ones before


def byte_letters() -> dict[str, int]:
    """The letter by which a vocabulary file writes each byte: itself if printable, else the next free one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


# Number of ids, their decimals with a comma before each, and their vocabulary strings joined.
Trace = tuple[int, bytes, bytes]


def _letters(word: str) -> bool:
    """Whether the word is one pre-token of letters, as far as all versions of Unicode agree on them."""
    return word.isalpha() and (word.isascii() or max(word) < "\u0250")


class Codec:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        if spec.get("normalizer") or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: normalizers and added tokens that strip or match whole words are not supported")
        if model.get("ignore_merges") or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{path}: ignore_merges and add_prefix_space are not supported")
        ids = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *self.added.values()]) + 1
        self.code = "H" if size <= 1 << 16 else "I"
        self.strings = [b""] * size
        for token, i in ids.items():
            self.strings[i] = bytes(letters[c] for c in token) if set(token) <= letters.keys() else token.encode()
        for token, i in self.added.items():
            self.strings[i] = token.encode()
        self.decimals = [b",%d" % i for i in range(size)]
        self.byte_ids = [0] * 256
        for c, b in letters.items():
            self.byte_ids[b] = ids[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
        self.ranks: dict[int, int] = {}
        for rank, (a, b, _) in enumerate(self.merges):
            self.ranks.setdefault(a << 32 | b, rank)
        self.pattern = regex.compile(PATTERN)
        words = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, words)) + ")") if words else None
        self.pieces: dict[str, bytes] = {}  # of pre-tokens
        self.runs: dict[str, bytes] = {}  # of runs that follow a space
        self.traced: dict[str, Trace] = {}  # what the runs that follow a space are coded to
        self.earlier: tuple[dict[str, bytes], dict[str, Trace]] = ({}, {})  # pieces and traced before they were full


    def merge(self, symbols: list[int]) -> list[int]:
        """The pair of lowest rank, leftmost first, becomes one symbol until no pair has a rank."""
        n, ranks, merges = len(symbols), self.ranks, self.merges
        queue = [
            rank * n + i
            for i in range(n - 1)
            if (rank := ranks.get(symbols[i] << 32 | symbols[i + 1])) is not None
        ]
        if not queue:
            return symbols
        heapify(queue)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while queue:
            rank, i = divmod(heappop(queue), n)
            left, right, merged = merges[rank]
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue  # stale: one of the two has been merged away since
            symbols[i], symbols[j] = merged, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (rank := ranks.get(merged << 32 | symbols[k])) is not None:
                    heappush(queue, rank * n + i)
            h = before[i]
            if h >= 0 and (rank := ranks.get(symbols[h] << 32 | merged)) is not None:
                heappush(queue, rank * n + h)
        return [s for s in symbols if s >= 0]

    def _merged(self, token: str) -> bytes:
        byte_ids = self.byte_ids
        return array(self.code, self.merge([byte_ids[b] for b in token.encode()])).tobytes()

    def piece(self, token: str) -> bytes:
        """Packed ids of one pre-token."""
        packed = self.pieces.get(token)
        if packed is None:
            packed = self.earlier[0].get(token)
            if packed is None:
                packed = self._merged(token)
            if len(token) <= 64:  # a giant is not worth keeping
                if len(self.pieces) >= MAX_CACHED:
                    self.earlier, self.pieces = (self.pieces, self.earlier[1]), {}
                self.pieces[token] = packed
        return packed

    def run(self, text: str) -> bytes:
        return b"".join(map(self.piece, self.pattern.findall(text)))

    def ordinary(self, text: str) -> bytes:
        if UNSAFE.search(text):
            return self.run(text)
        first, *rest = text.split(" ")
        packed = list(map(self.runs.get, rest))
        if None in packed:
            for k, found in enumerate(packed):
                if found is None:
                    word = rest[k]
                    found = self.runs.get(word)
                    if found is None:
                        found = self.run(" " + word)
                        if len(word) <= 64:
                            if len(self.runs) >= MAX_CACHED:
                                self.runs.clear()
                            self.runs[word] = found
                    packed[k] = found
        return self.run(first) + b"".join(packed)

    def encode(self, text: str | None) -> array:
        """Ids of a whole text; strings of added tokens in it become their ids."""
        ids = array(self.code)
        if not text:
            return ids
        if self.special and self.special.search(text):
            for part in self.special.split(text):
                if part in self.added:
                    ids.append(self.added[part])
                elif part:
                    ids.frombytes(self.ordinary(part))
        else:
            ids.frombytes(self.ordinary(text))
        return ids

    def trace(self, packed: bytes) -> Trace:
        ids = array(self.code, packed)
        return len(ids), b"".join(map(self.decimals.__getitem__, ids)), b"".join(map(self.strings.__getitem__, ids))

    @cached_property
    def marks(self) -> dict[str, Trace]:
        return {m: self.trace(self.run(m)) for m in ".,;:!?"}

    def _traced(self, word: str) -> Trace:
        """Of the run `word` after a space. Words are kept, so that a known one costs one lookup; a word with a mark
        behind it is put together from both, and runs over several lines, which hardly come again, are not kept."""
        found = self.traced.get(word)
        if found is None:
            stem, mark = word[:-1], self.marks.get(word[-1:])
            if mark and _letters(stem):
                n, decimals, strings = self._traced(stem)
                return n + mark[0], decimals + mark[1], strings + mark[2]
            found = self.earlier[1].get(word)
            if found is None:
                # A word of letters is one pre-token.
                packed = self._merged(" " + word) if _letters(word) else self.run(" " + word)
                found = self.trace(packed)
            if len(word) <= 64 and "\n" not in word:
                if len(self.traced) >= MAX_TRACED:
                    self.earlier, self.traced = (self.earlier[0], self.traced), {}
                self.traced[word] = found
        return found

    def _traces(self, text: str) -> list[Trace]:
        """Of text without added tokens, in order."""
        if UNSAFE.search(text):
            return [self.trace(self.run(text))]
        first, *rest = text.split(" ")
        found = list(map(self.traced.get, rest))
        if None in found:
            found = [self._traced(word) if known is None else known for word, known in zip(rest, found, strict=True)]
        return [self.trace(self.run(first)), *found] if first else found

    def digests(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of their decimals joined by commas, SHA-256 of the decoded text."""
        if text and self.special and self.special.search(text):
            parts = []
            for part in self.special.split(text):
                if part in self.added:
                    parts.append(self.trace(array(self.code, [self.added[part]]).tobytes()))
                elif part:
                    parts += self._traces(part)
        else:
            parts = self._traces(text) if text else []
        counts, decimals, strings = zip(*parts, strict=True) if parts else ((), (), ())
        return sum(counts), hashlib.sha256(b"".join(decimals)[1:]).hexdigest(), hashlib.sha256(_as_text(b"".join(strings))).hexdigest()

    def decode(self, ids) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One per Python worker. The file has to be readable at this path on every executor."""
    return Codec(path)


def _as_text(data: bytes) -> bytes:
    """UTF-8 of what decodes from these bytes: themselves, or with replacement characters where they are not UTF-8."""
    try:
        data.decode()
    except UnicodeDecodeError:
        return data.decode("utf-8", "replace").encode()
    return data


def encode(df: DataFrame, path: str) -> DataFrame:
    """doc_id, ids array<int> of every text; one row per input row, whatever is null or repeated."""

    def make():
        model = codec(path)

        def work(batch):
            ids = [model.encode(t) for t in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

        return work

    return map_texts(df, ["doc_id", "text"], make, "doc_id long, ids array<int>")


def decode(df: DataFrame, path: str) -> DataFrame:
    """doc_id, text of doc_id, ids: the inverse of `encode`."""

    def make():
        model = codec(path)

        def work(batch):
            texts = [model.decode(i or []) for i in batch.column("ids").to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

        return work

    return map_texts(df, ["doc_id", "ids"], make, "doc_id long, text string")


def round_trip(df: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoding and decoding in one pass, so that the ids of
    the corpus are neither shuffled nor sent back to the JVM. A known run carries the decimals and the vocabulary
    strings of its ids, so a document is one join over its runs."""

    def make():
        model = codec(path)

        def work(batch):
            rows = [model.digests(text) for text in batch.column("text").to_pylist()]
            counts, ids_sha, texts_sha = zip(*rows, strict=True) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(texts_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

        return work

    return map_texts(
        df, ["doc_id", "text"], make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
