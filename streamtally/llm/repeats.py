"""Removal of byte strings that repeat across documents, by enhanced suffix arrays over anchored text.

Every LENGTH-byte window has an anchor: the first of its GRAM-byte strings with the least hash. Equal
windows have their anchor at the same place, so only suffixes that start at anchors are needed, about one in
fourteen, and all that can repeat together meets in one bucket, by the anchor's hash.

1. Each batch of documents sends the hashes of its anchors, each once; a bucket answers which of them
   other batches have as well, one bit each, and which are hot: of more than HOT occurrences in all.
2. For anchors of more than one document the batch sends the text of the windows they stand for, equal
   pieces once, with the smallest doc_id. A bucket sorts these suffixes, takes their common prefixes,
   and builds the tree of common-prefix intervals with one scan over a stack. An interval is a repeated
   string with all its occurrences; it is split by what stands to the left of the anchor, read off a
   second suffix array of the reversed left sides, until each class is one window's occurrences. The
   smallest doc_id of a class goes back to the batch.
3. The batch marks the windows whose class has a smaller doc_id than their own document.

A string in very many documents is sent once per batch, so no task gets all its occurrences. Of a short
one with other neighbours in each document, pieces differ in every document; it is hot, and instead of
pieces its windows are sent, each named by 128 bits and dealt by them, once per batch with the smallest
doc_id. Equal windows meet, and one anchor is spread over all buckets of windows. All three steps read the
documents from the same shuffle.

Null texts are empty; texts of fewer than LENGTH bytes keep everything. A null doc_id comes after all
others; rows that share a doc_id remove nothing from each other.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from streamtally.llm.hashes import byte_noise, mixed, powers

LENGTH, GRAM = 50, 24
REACH = LENGTH - GRAM  # farthest an anchor can be from the start of its window
LAST = np.iinfo(np.int64).max
CHUNK = 1 << 20  # windows handled at once
BATCH_BYTES = 2 << 20
HOT = 20_000  # occurrences from which an anchor's windows are dealt one by one


class Anchors:
    """Runs of windows with a common anchor, of the documents `data[start:end]`: first and last window,
    anchor, document and hash of the anchor's bytes."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        parts = []
        for a in range(0, max(len(data) - LENGTH + 1, 0), CHUNK):
            b = min(a + CHUNK, len(data) - LENGTH + 1)
            parts.append(self._chunk(data, start, end, a, b))
        kinds = (np.int64, np.int64, np.int64, np.int64, np.uint64)
        self.first, self.last, self.at, self.doc, self.hash = (
            np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, kind) for k, kind in enumerate(kinds)
        )

    @staticmethod
    def _chunk(data, start, end, a, b):
        """Of the windows that start in a..b-1."""
        n = b - a + REACH  # strings of GRAM bytes
        up, down = powers(CHUNK + LENGTH + 1)
        sums = np.zeros(n + GRAM, np.uint64)
        np.cumsum(byte_noise()[data[a : a + n + GRAM - 1]] * up[: n + GRAM - 1], out=sums[1:])
        grams = mixed((sums[GRAM:] - sums[:-GRAM]) * down[:n])
        least, offset = (grams >> np.uint64(32)).astype(np.uint32), np.zeros(n, np.uint8)
        width = 1
        while width < REACH + 1:  # least of the next `width` strings; of equal ones the first
            step = min(width, REACH + 1 - width)
            ahead = least[step:]
            better = ahead < least[: len(ahead)]
            offset = np.where(better, offset[step:] + np.uint8(step), offset[: len(ahead)])
            least = np.minimum(ahead, least[: len(ahead)])
            width += step
        lo, hi = np.searchsorted(end, a, "right"), np.searchsorted(start, b, "left")
        left, right = np.maximum(start[lo:hi], a), np.minimum(end[lo:hi] - LENGTH + 1, b)
        some = np.flatnonzero(right > left)
        counts = (right - left)[some]
        if not len(some):
            return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),)
        doc = np.repeat(some + lo, counts)
        window = np.arange(counts.sum()) + np.repeat(left[some] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
        at = window + offset[window - a]
        new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])]))
        ends = np.append(new[1:], len(at)) - 1
        return window[new], window[ends], at[new], doc[new], grams[at[new] - a]

    def buckets(self, n: int) -> np.ndarray:
        return ((self.hash >> np.uint64(32)) % np.uint64(n)).astype(np.int64)


class Batch:
    """One batch of documents; the same rows give the same anchors and pieces in the same order."""

    def __init__(self, ids: list[int | None], texts: list[str | None]):
        self.texts = [t.encode() if t else b"" for t in texts]
        self.ids = np.array([LAST if i is None else i for i in ids], np.int64)
        lengths = np.array([len(t) for t in self.texts], np.int64)
        self.end = np.cumsum(lengths)
        self.start = self.end - lengths
        self.data = np.frombuffer(b"".join(self.texts), np.uint8)
        self.anchors = Anchors(self.data, self.start, self.end)

    def windows(self, hot: np.ndarray, buckets: int):
        """Of the anchors that are hot: bucket, the two names and the smallest doc_id of each distinct window, in
        order of bucket; then the start, the document and the place among the distinct ones of each window."""
        a = self.anchors
        use = np.flatnonzero(hot)
        n = a.last[use] - a.first[use] + 1
        begin = np.repeat(a.first[use], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        doc = self.ids[np.repeat(a.doc[use], n)]
        up, _ = powers(LENGTH)
        names = np.zeros((2, len(begin)), np.uint64)
        for lo in range(0, len(begin), 1 << 16):
            part = slice(lo, lo + (1 << 16))
            text = self.data[begin[part, None] + np.arange(LENGTH)]
            for k, noise in enumerate((byte_noise(), more_noise())):
                names[k, part] = mixed((noise[text] * up[:LENGTH]).sum(axis=1, dtype=np.uint64))
        bucket = buckets + (names[0] % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((doc, names[1], names[0], bucket))
        new = np.ones(len(order), bool)
        new[1:] = (names[:, order][:, 1:] != names[:, order][:, :-1]).any(axis=0)
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        heads = order[new]
        return bucket[heads], names[:, heads], doc[heads], begin, doc, place

    def hashes(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchor hashes as bucket and low half, in order; and of each anchor its place among them."""
        low = self.anchors.hash & np.uint64(0xFFFFFFFF)
        key = (self.anchors.buckets(buckets).astype(np.uint64) << np.uint64(32)) | low
        distinct, place = np.unique(key, return_inverse=True)
        return (distinct >> np.uint64(32)).astype(np.int64), distinct.astype(np.uint32), place

    def pieces(self, shared: np.ndarray, buckets: int):
        """Of the anchors that may repeat: bucket, first anchor that has the piece, and smallest doc_id of each
        distinct piece, in order of bucket; then the anchors and of each its piece."""
        a = self.anchors
        use = np.flatnonzero(shared)
        first, size = a.first[use], a.last[use] - a.first[use] + LENGTH
        name = np.zeros(len(use), np.uint64)
        for lo in range(0, len(use), 1 << 16):
            part = slice(lo, lo + (1 << 16))
            width = int(size[part].max())
            columns = np.arange(width)
            where = np.minimum(first[part, None] + columns, len(self.data) - 1)
            up, _ = powers(CHUNK + LENGTH + 1)
            name[part] = np.where(columns < size[part, None], byte_noise()[self.data[where]] * up[:width], 0).sum(axis=1, dtype=np.uint64)
        name = mixed(name + size.astype(np.uint64)) ^ mixed((a.at[use] - first).astype(np.uint64) + np.uint64(77))
        bucket = a.buckets(buckets)[use]
        order = np.lexsort((self.ids[a.doc[use]], name, bucket))
        new = np.concatenate([[True], (name[order][1:] != name[order][:-1]) | (bucket[order][1:] != bucket[order][:-1])]) if len(order) else np.zeros(0, bool)
        piece = np.empty(len(use), np.int64)
        piece[order] = np.cumsum(new) - 1
        heads = order[new]
        return bucket[heads], use[heads], self.ids[a.doc[use[heads]]], use, piece


@lru_cache(maxsize=1)
def more_noise() -> np.ndarray:
    return np.random.default_rng(6).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _pack(*arrays: np.ndarray) -> bytes:
    return zstandard.compress(b"".join(x.tobytes() for x in arrays), 1)


def _runs(values: np.ndarray):
    """(value, start, end) of runs of equal values."""
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)], strict=True):
        if b > a:
            yield int(values[a]), a, b


def send_hashes(batch: int, rows: Batch, buckets: int) -> list[tuple[int, int, bytes]]:
    """Per bucket: number of hashes, hashes, and places and counts of those that occur more than once."""
    bucket, low, place = rows.hashes(buckets)
    counts = np.bincount(place, minlength=len(low)).astype(np.uint32)
    out = []
    for b, i, j in _runs(bucket):
        many = np.flatnonzero(counts[i:j] > 1).astype(np.uint32)
        out.append((b, batch, b"".join(x.tobytes() for x in (np.uint32(j - i), low[i:j], many, counts[i:j][many]))))
    return out


def answer_hashes(parts: list[bytes], hot: int = HOT) -> list[bytes]:
    """Of each part's hashes, whether another part has them too, as bits, and the places of the hot ones."""
    arrays, occurrences = [], []
    for p in parts:
        numbers = np.frombuffer(p, np.uint32)
        n = int(numbers[0])
        places, counts = numbers[1 + n :].reshape(2, -1)
        own = np.ones(n, np.int64)
        own[places] = counts
        arrays.append(numbers[1 : 1 + n])
        occurrences.append(own)
    values, place, counts = np.unique(np.concatenate(arrays), return_inverse=True, return_counts=True)
    twice = counts[place] > 1
    total = np.zeros(len(values), np.int64)
    np.add.at(total, place, np.concatenate(occurrences))
    many = total[place] > hot
    cuts = np.cumsum([len(a) for a in arrays])[:-1]
    return [np.packbits(x).tobytes() + np.flatnonzero(y).astype(np.uint32).tobytes() for x, y in zip(np.split(twice, cuts), np.split(many, cuts), strict=True)]


def shared_anchors(rows: Batch, answers: dict[int, bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Which anchors stand in more than one document, here or in other batches; of these, those that are not hot and those that are."""
    bucket, _, place = rows.hashes(buckets)
    elsewhere, hot = np.zeros(len(bucket), bool), np.zeros(len(bucket), bool)
    for b, i, j in _runs(bucket):
        if b in answers:
            bits = -(-(j - i) // 8)
            elsewhere[i:j] = np.unpackbits(np.frombuffer(answers[b][:bits], np.uint8), count=j - i).astype(bool)
            hot[i + np.frombuffer(answers[b][bits:], np.uint32).astype(np.int64)] = True
    low, high = np.full(len(bucket), LAST), np.full(len(bucket), -1)
    np.minimum.at(low, place, rows.anchors.doc)
    np.maximum.at(high, place, rows.anchors.doc)
    shared = elsewhere | (low < high)
    return (shared & ~hot)[place], (shared & hot)[place]


def send_windows(batch: int, rows: Batch, hot: np.ndarray, buckets: int) -> list[tuple[int, int, bytes]]:
    if not hot.any():
        return []
    bucket, names, doc, *_ = rows.windows(hot, buckets)
    return [(b, batch, np.concatenate([names[0, i:j], names[1, i:j], doc[i:j].view(np.uint64)]).tobytes()) for b, i, j in _runs(bucket)]


def answer_windows(parts: list[bytes]) -> list[bytes]:
    """Of each part's windows, in order, the smallest doc_id that has it."""
    arrays = [np.frombuffer(p, np.uint64).reshape(3, -1) for p in parts]
    first, second, doc = np.concatenate(arrays, axis=1)
    doc = doc.view(np.int64)
    order = np.lexsort((second, first))
    new = np.ones(len(order), bool)
    new[1:] = (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])
    heads = np.flatnonzero(new)
    least = np.empty(len(order), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(doc[order], heads), np.diff(np.append(heads, len(order))))
    return [_pack(x) for x in np.split(least, np.cumsum([a.shape[1] for a in arrays])[:-1])]


def send_pieces(batch: int, rows: Batch, shared: np.ndarray, buckets: int) -> list[tuple[int, int, bytes]]:
    bucket, head, doc, _, _ = rows.pieces(shared, buckets)
    a = rows.anchors
    size = (a.last[head] - a.first[head] + LENGTH).astype(np.uint8)
    offset = (a.at[head] - a.first[head]).astype(np.uint8)
    out = []
    for b, i, j in _runs(bucket):
        n = size[i:j].astype(np.int64)
        at = np.arange(n.sum()) + np.repeat(a.first[head[i:j]] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        out.append((b, batch, np.uint32(j - i).tobytes() + _pack(size[i:j], offset[i:j], doc[i:j], rows.data[at])))
    return out


def intervals(common: list[int], floor: int) -> tuple[np.ndarray, ...]:
    """Common-prefix intervals of a sorted suffix array: depth, depth of the parent, first and last suffix.

    `common[i]` is the length of the common prefix of suffixes i and i+1. One scan; the stack holds the open
    intervals, each deeper than the one below. Intervals of depth under `floor` are left out.
    """
    depths, parents, lefts, rights = [], [], [], []
    stack: list[tuple[int, int]] = []
    for i, c in enumerate([*common, 0]):
        left = i
        while stack and stack[-1][0] > c:
            depth, left = stack.pop()
            parent = max(c, stack[-1][0] if stack else 0)
            if depth >= floor:
                depths.append(depth)
                parents.append(parent)
                lefts.append(left)
                rights.append(i)
        if c and (not stack or stack[-1][0] < c):
            stack.append((c, left))
    return tuple(np.array(x, np.int64) for x in (depths, parents, lefts, rights))


def _sorted_sides(data: np.ndarray, first: np.ndarray, step: int, width: int, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings that start at `first` and go on in one direction, and common prefixes of neighbours in it."""
    columns = np.arange(width)
    at = np.clip(first[:, None] + step * columns, 0, len(data) - 1)
    side = np.where(columns < room[:, None], data[at], 0).astype(np.uint8)
    order = np.argsort(np.ascontiguousarray(side).view(f"S{width}").ravel(), kind="stable")
    side = side[order]
    differs = side[1:] != side[:-1]
    return order, np.where(differs.any(axis=1), differs.argmax(axis=1), width)


def smallest_docs(data: np.ndarray, start: np.ndarray, size: np.ndarray, offset: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Per piece and distance of its anchor from a window's start: the smallest doc_id that has this window."""
    n = len(start)
    out = np.repeat(doc[:, None], REACH + 1, axis=1)
    right_room, anchor = size - offset, start + offset
    right, right_common = _sorted_sides(data, anchor, 1, LENGTH, right_room)
    left, left_common = _sorted_sides(data, anchor - 1, -1, REACH, offset)
    depth, parent, lo, hi = intervals(right_common.tolist(), GRAM)
    for o in range(REACH + 1):
        need = LENGTH - o
        chosen = np.flatnonzero((depth >= need) & (parent < need))
        if not len(chosen):
            continue
        turn = np.argsort(lo[chosen])
        a, b = lo[chosen][turn], hi[chosen][turn]
        widths = b - a + 1
        members = right[np.arange(widths.sum()) + np.repeat(a - np.concatenate([[0], np.cumsum(widths)[:-1]]), widths)]
        label = np.repeat(np.arange(len(a)), widths)
        fits = (offset[members] >= o) & (right_room[members] >= need)
        members, label = members[fits], label[fits]
        if not len(members):
            continue
        # Left sides that agree in o bytes are one class.
        side = np.empty(n, np.int64)
        side[left] = np.concatenate([[0], np.cumsum(left_common < o)])
        key = label * n + side[members]
        order = np.argsort(key, kind="stable")
        heads = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
        least = np.minimum.reduceat(doc[members[order]], heads)
        out[members[order], o] = np.repeat(least, np.diff(np.append(heads, len(order))))
    return out


def answer_pieces(parts: list[bytes]) -> list[bytes]:
    """Of each window of each part's pieces, in order, the smallest doc_id that has it."""
    sizes, offsets, docs, texts = [], [], [], []
    for p in parts:
        n = int(np.frombuffer(p[:4], np.uint32)[0])
        raw = zstandard.decompress(p[4:])
        sizes.append(np.frombuffer(raw[:n], np.uint8).astype(np.int64))
        offsets.append(np.frombuffer(raw[n : 2 * n], np.uint8).astype(np.int64))
        docs.append(np.frombuffer(raw[2 * n : 10 * n], np.int64))
        texts.append(np.frombuffer(raw[10 * n :], np.uint8))
    size, offset, doc, data = (np.concatenate(x) for x in (sizes, offsets, docs, texts))
    start = np.cumsum(size) - size
    least = smallest_docs(data, start, size, offset, doc)
    windows = size - LENGTH + 1
    owner = np.repeat(np.arange(len(size)), windows)
    number = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    flat = least[owner, offset[owner] - number]
    cuts = np.cumsum([int((s - LENGTH + 1).sum()) for s in sizes])[:-1]
    return [_pack(x) for x in np.split(flat, cuts)]


def covered(rows: Batch, shared: np.ndarray, hot: np.ndarray, answers: dict[int, bytes], buckets: int) -> np.ndarray:
    """Which bytes of the batch stand in a window that a document with a smaller doc_id has too."""
    bucket, head, _, use, piece = rows.pieces(shared, buckets)
    a = rows.anchors
    windows = a.last[head] - a.first[head] + 1
    flat = np.concatenate([np.frombuffer(zstandard.decompress(answers[b]), np.int64) for b, _, _ in _runs(bucket)] or [np.zeros(0, np.int64)])
    begin = np.cumsum(windows) - windows
    n = windows[piece]
    number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    least = flat[np.repeat(begin[piece], n) + number]
    hit = least < np.repeat(rows.ids[a.doc[use]], n)
    at = (np.repeat(a.first[use], n) + number)[hit]
    if hot.any():
        bucket, _, _, start, doc, place = rows.windows(hot, buckets)
        flat = np.concatenate([np.frombuffer(zstandard.decompress(answers[b]), np.int64) for b, _, _ in _runs(bucket)])
        at = np.concatenate([at, start[flat[place] < doc]])
    edges = np.zeros(len(rows.data) + 1, np.int64)
    np.add.at(edges, at, 1)
    np.subtract.at(edges, at + LENGTH, 1)
    return np.cumsum(edges)[:-1] > 0


def spans(rows: Batch, gone: np.ndarray) -> list[list[tuple[int, int]]]:
    """Removed runs of each document, as offsets in its bytes."""
    out = []
    for i, j in zip(rows.start.tolist(), rows.end.tolist(), strict=True):
        part = gone[i:j]
        if not part.any():
            out.append([])
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[0], part.astype(np.int8), [0]])))
        out.append(list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)))
    return out


def without(text: bytes, gone: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for a, b in gone:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]])


def whole_characters(text: bytes, gone: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs without the bytes of characters of which only a part would go."""
    out = []
    for a, b in gone:
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


OWN_BATCH = "__batch"  # a name that documents do not have
ANSWER = "batch long, bucket long, answer binary"


def _table(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[] for _ in names]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, types, strict=True)})


def _batch_of(table: pa.Table) -> tuple[int, Batch]:
    return table[OWN_BATCH][0].as_py(), Batch(table["doc_id"].to_pylist(), table["text"].to_pylist())


def _answers(table: pa.Table) -> dict[int, bytes]:
    return dict(zip(table["bucket"].to_pylist(), table["answer"].to_pylist(), strict=True))


def remove_repeats(df: DataFrame, finish, schema: str | StructType, carry: list[str] | None = None, batch_bytes: int = BATCH_BYTES, hot: int = HOT) -> DataFrame:
    """Rows made by `finish(table of the batch's documents, Batch, removed runs of each)`, a pyarrow table per batch."""
    volume = df.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Both follow the volume alone: what batches and buckets tell each other must not grow with the cluster.
    batches, buckets = max(1, -(-volume // batch_bytes)), max(1, -(-volume // (4 * batch_bytes)))
    text = F.coalesce("text", F.lit(""))
    extra = [c for c in carry or [] if c not in ("doc_id", "text")]
    placed = df.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *extra).withColumn(
        OWN_BATCH, F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches))
    )
    order = {"names": ["bucket", "batch", "part"], "types": [pa.int64(), pa.int64(), pa.binary()]}
    back = {"names": ["batch", "bucket", "answer"], "types": [pa.int64(), pa.int64(), pa.binary()]}

    def ask(table: pa.Table) -> pa.Table:
        return _table(send_hashes(*_batch_of(_steady(table)), buckets), **order)

    def reply(make):
        def run(table: pa.Table) -> pa.Table:
            answers = make(table["bucket"][0].as_py())(table["part"].to_pylist())
            return _table(list(zip(table["batch"].to_pylist(), table["bucket"].to_pylist(), answers, strict=True)), **back)

        return run

    def show(table: pa.Table, answers: pa.Table) -> pa.Table:
        batch, rows = _batch_of(_steady(table))
        shared, many = shared_anchors(rows, _answers(answers), buckets)
        return _table(send_pieces(batch, rows, shared, buckets) + send_windows(batch, rows, many, buckets), **order)

    def end(table: pa.Table, answers: pa.Table) -> pa.Table:
        table = _steady(table)
        _, rows = _batch_of(table)
        kinds = answers["kind"].to_pylist()
        first = answers.filter(pa.array([k == 0 for k in kinds], pa.bool_()))
        second = answers.filter(pa.array([k == 1 for k in kinds], pa.bool_()))
        shared, many = shared_anchors(rows, _answers(first), buckets)
        return finish(table, rows, spans(rows, covered(rows, shared, many, _answers(second), buckets)))

    sent = "bucket long, batch long, part binary"
    heard = placed.groupBy(OWN_BATCH).applyInArrow(ask, sent).groupBy("bucket").applyInArrow(reply(lambda _: partial(answer_hashes, hot=hot)), ANSWER)
    shown = placed.groupBy(OWN_BATCH).cogroup(heard.groupBy("batch")).applyInArrow(show, sent)
    found = shown.groupBy("bucket").applyInArrow(reply(lambda bucket: answer_pieces if bucket < buckets else answer_windows), ANSWER)
    both = heard.withColumn("kind", F.lit(0)).union(found.withColumn("kind", F.lit(1)))
    return placed.groupBy(OWN_BATCH).cogroup(both.groupBy("batch")).applyInArrow(end, schema)


def _steady(table: pa.Table) -> pa.Table:
    """Rows in an order that does not depend on the shuffle."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def removed_digests(df: DataFrame, batch_bytes: int = BATCH_BYTES, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed runs as byte offsets."""

    def finish(table, rows, gone):
        kept = [without(t, g) for t, g in zip(rows.texts, gone, strict=True)]
        n = [len(t) for t in rows.texts]
        run = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table(
            {
                "doc_id": table["doc_id"], "n_bytes": pa.array(n, pa.int64()),
                "n_removed": pa.array([a - len(k) for a, k in zip(n, kept, strict=True)], pa.int64()),
                "n_spans": pa.array([len(g) for g in gone], pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                "spans": pa.array([[{"start": a, "end": b} for a, b in g] for g in gone], run),
            }
        )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>"
    return remove_repeats(df, finish, schema, batch_bytes=batch_bytes, hot=hot)


def cleaned(df: DataFrame) -> DataFrame:
    """The same rows and columns, `text` without its repeated strings; only whole characters are removed. Null texts become empty."""

    columns = df.columns

    def finish(table, rows, gone):
        texts = [without(t, whole_characters(t, g)).decode() for t, g in zip(rows.texts, gone, strict=True)]
        return pa.table({c: pa.array(texts, pa.string()) if c == "text" else table[c] for c in columns})

    return remove_repeats(df, finish, df.schema, columns)
