"""Plain restatements of what the text operators compute, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def shingles(text: str | None, k: int = 5) -> frozenset:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def components(docs: list[tuple[int, str | None]], percent: int) -> dict[int, tuple[int, int]]:
    """doc_id -> (set size, smallest id reachable)."""
    sets = {i: shingles(t) for i, t in docs}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        common = Counter(j for x in s for j in holders[x] if j < i)
        for j, both in common.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def repeats(docs: list[tuple[int, str | None]], length: int = 50) -> dict[int, tuple]:
    """doc_id -> (bytes, removed, runs, digest of the rest)."""
    first: dict[bytes, int] = {}
    for i, t in sorted(docs):
        data = (t or "").encode()
        for k in range(len(data) - length + 1):
            first.setdefault(data[k : k + length], i)
    out = {}
    for i, t in docs:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            if first[data[k : k + length]] < i:
                gone[k : k + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(data), sum(gone), runs, sha(kept))
    return out


def word_counts(text: str | None) -> dict[str, int]:
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    marked = {k + d for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(marked),
    }


def jaccard(a: str, b: str) -> float:
    """Generalised Jaccard similarity of the word counts."""
    x, y = Counter(WORD.findall(a)), Counter(WORD.findall(b))
    both, any_ = sum((x & y).values()), sum((x | y).values())
    return both / any_ if any_ else 1.0
