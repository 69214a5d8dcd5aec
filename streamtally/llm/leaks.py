"""Benchmark decontamination: a broadcast hash set of the benchmark's word windows, against every document's windows.

Words are those of `terms`. A window is `size` consecutive words of an item; an item with fewer words, but
not none, is one window. Documents are scanned whole: the hash of each of their windows is looked up, a hit is
verified by the SHA-256 of its words, and the words under verified windows are hit. Nothing is shuffled.

What is broadcast has a bound, whatever the benchmark's size: BLOCK pairs of window and item, 52 bytes each.
A larger benchmark is dealt into blocks by hash, the documents are scanned once a block, and the hits of equal
texts, which are few, are put together. Long words do not count, as windows travel as digests.

Defined results: null and empty texts have no words and no hits; repeated rows keep their rows; an empty
benchmark hits nothing; the windows of items without item_id hit words, but such items are not named; equal
item_ids are one item. Columns of any name are carried through unchanged.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from streamtally.llm import terms
from streamtally.llm.common import written
from streamtally.llm.hashes import mixed

WINDOW = 10
BLOCK = 500_000

FOUND = (
    "n_words long, n_hit long, items array<string>, "
    "runs array<struct<first:int,last:int,start:int,end:int>>, clean string"
)
_RUN = pa.struct([(n, pa.int32()) for n in ("first", "last", "start", "end")])


def _window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on; the last n - 1 reach beyond the words and mean nothing."""
    factors = np.random.default_rng(29).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    total = np.full(len(hashes), n, np.uint64)
    for k in range(n):
        total += padded[k : k + len(hashes)] * factors[k]
    return mixed(total)


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """item string, n (words), hash, digest: the distinct windows of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in terms.small_batches(batches):
            w = terms.words(batch.column("text"))
            hashes, by_size = w.hashes(), {}
            for i, item in enumerate(batch.column("item").to_pylist()):
                first, n = int(w.first[i]), int(w.first[i + 1] - w.first[i])
                m = min(n, size)
                if m and m not in by_size:
                    by_size[m] = _window_hashes(hashes, m).view(np.int64)
                at = range(first, first + n - m + 1) if m else range(0)
                for a in range(at.start, at.stop, 10_000):
                    part = range(a, min(a + 10_000, at.stop))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([item] * len(part), pa.string()), pa.array([m] * len(part), pa.int32()),
                            pa.array(by_size[m][part.start : part.stop]), pa.array([hashlib.sha256(w.joined(p, m)).digest() for p in part], pa.binary()),
                        ],
                        ["item", "n", "hash", "digest"],
                    )

    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    return items.mapInArrow(run, "item string, n int, hash long, digest binary").distinct()


class WindowSet:
    """One block of windows as it stands in each Python worker."""

    def __init__(self, table: pa.Table):
        order = np.argsort(table["hash"].to_numpy().view(np.uint64), kind="stable")
        table = table.take(pa.array(order))
        self.hash = table["hash"].to_numpy().view(np.uint64)
        self.n = table["n"].to_numpy()
        self.digest = table["digest"].to_pylist()
        self.item = table["item"].to_pylist()
        self.sets = {int(m): terms.HashSet(self.hash[self.n == m]) for m in np.unique(self.n)}

    def matches(self, h: np.uint64, m: int, words: bytes) -> list[str | None] | None:
        """The items of the window with these words, or None if it is none of theirs."""
        digest = hashlib.sha256(words).digest()
        a, b = np.searchsorted(self.hash, h, "left"), np.searchsorted(self.hash, h, "right")
        found = [self.item[k] for k in range(a, b) if self.n[k] == m and self.digest[k] == digest]
        return found or None

    def scan(self, texts: pa.Array, clean: bool) -> list[pa.Array]:
        """The columns of FOUND."""
        w = terms.words(texts)
        hashes, counts = w.hashes(), np.diff(w.first)
        step = np.zeros(len(hashes) + 1, np.int64)  # hits begin and end
        items: dict[int, set] = {}
        known: dict[tuple[int, int], list | None] = {}
        owner = w.owner
        for m, own in self.sets.items():
            made = _window_hashes(hashes, m)
            at, _ = own.find(made)
            at = at[at + m <= w.first[owner[at] + 1]]
            for p in at.tolist():
                words = w.joined(p, m)
                key = (m, words)
                if key not in known:
                    known[key] = self.matches(made[p], m, words)
                if known[key]:
                    step[p] += 1
                    step[p + m] -= 1
                    items.setdefault(int(owner[p]), set()).update(known[key])
        hit = np.cumsum(step)[:-1] > 0
        n_hit = np.bincount(owner[hit], minlength=len(texts))
        return [
            pa.array(counts), pa.array(n_hit),
            pa.array([sorted(x for x in items.get(i, ()) if x is not None) for i in range(len(texts))], pa.list_(pa.string())),
            *_runs(w, texts, hit, n_hit, clean),
        ]


def _runs(w: terms.Words, texts: pa.Array, hit: np.ndarray, n_hit: np.ndarray, clean: bool) -> list[pa.Array]:
    """The maximal runs of hit words of each text, in words and in code points, and the text without them."""
    points = None
    runs: list[list[dict]] = [[] for _ in range(len(texts))]
    rest = texts.cast(pa.string()).to_pylist() if clean else [None] * len(texts)
    for i in np.flatnonzero(n_hit).tolist():
        if points is None:
            points = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
        a, b, base = int(w.first[i]), int(w.first[i + 1]), int(w.offsets[i])
        flags = np.concatenate([[False], hit[a:b], [False]])
        edges = np.flatnonzero(flags[1:] != flags[:-1])
        places = []
        for f, t in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            x, y = int(w.start[a + f]), int(w.end[a + t - 1])
            places.append((x - base, y - base))
            runs[i].append({"first": f, "last": t - 1, "start": int(points[x] - points[base]), "end": int(points[y] - points[base])})
        if clean:
            raw = texts[i].as_py().encode()
            ends = [0, *[y for _, y in places]]
            starts = [*[x for x, _ in places], len(raw)]
            rest[i] = b"".join(raw[e:s] for e, s in zip(ends, starts, strict=True)).decode()
    return [pa.array(runs, pa.list_(_RUN)), pa.array(rest, pa.string())]


def _one_pass(docs: DataFrame, grams: DataFrame, clean: bool) -> DataFrame:
    """docs' columns (text is read, the others are carried) and FOUND, for one block of windows."""
    sent = docs.sparkSession.sparkContext.broadcast(grams.toArrow())  # at most BLOCK rows of 52 bytes
    kept, name = docs.columns, uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _window_set(name, sent)
        for batch in terms.small_batches(batches):
            found = own.scan(batch.column("text"), clean)
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*kept, "n_words", "n_hit", "items", "runs", "clean"])

    schema = StructType(docs.schema.fields + StructType.fromDDL(FOUND).fields)
    return docs.mapInArrow(run, schema)


_sets: dict[str, WindowSet] = {}


def _window_set(name: str, sent: Broadcast) -> WindowSet:
    """Built once per Python worker; an earlier pass's set goes."""
    if name not in _sets:
        _sets.clear()
        _sets[name] = WindowSet(sent.value)
    return _sets[name]


def _united(hits: DataFrame) -> DataFrame:
    """digest, items, runs of several blocks' hits: the union of their items and of their hit words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for runs in batch.column("runs").to_pylist():
                merged: list[dict] = []
                for r in sorted(runs, key=lambda r: r["first"]):
                    if merged and r["first"] <= merged[-1]["last"] + 1:
                        if r["last"] > merged[-1]["last"]:
                            merged[-1] |= {"last": r["last"], "end": r["end"]}
                    else:
                        merged.append(dict(r))
                out.append(merged)
            yield pa.RecordBatch.from_arrays([batch.column("digest"), batch.column("items"), pa.array(out, pa.list_(_RUN))], ["digest", "items", "runs"])

    one = hits.groupBy("digest").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.flatten(F.collect_list("runs")).alias("runs")
    )  # a row per block at most
    return one.mapInArrow(run, "digest binary, items array<string>, runs array<struct<first:int,last:int,start:int,end:int>>")


def scan(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, clean: bool = False, block: int = BLOCK) -> DataFrame:
    """docs' columns as c0, c1, ... in their order, and n_words, n_hit, items (sorted), runs (first and last word,
    start and end in code points, counted from 0, ends after the run), clean (the text without its runs, if asked for)."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = f"c{docs.columns.index('text')}"
    grams = written(windows(benchmark, size), "windows")
    blocks = -(-grams.count() // block)
    if blocks <= 1:
        found = _one_pass(plain.withColumnRenamed(text, "text"), grams, clean)
        return found.withColumnRenamed("text", text)
    dealt = grams.withColumn("block", F.pmod(F.xxhash64("digest", "item"), F.lit(blocks)))
    digest = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).alias("digest")
    texts = plain.select(digest, F.col(text).alias("text"))
    hits = None
    for b in range(blocks):
        own = _one_pass(texts, dealt.where(F.col("block") == b).drop("block"), False)
        own = own.where("n_hit > 0").select("digest", "items", "runs").distinct()
        hits = own if hits is None else hits.unionByName(own)
    both = plain.withColumn("__digest", digest).join(_united(written(hits, "hits")), F.col("__digest") == F.col("digest"), "left")
    runs = F.coalesce("runs", F.array().cast("array<struct<first:int,last:int,start:int,end:int>>"))
    keep = F.concat(F.transform(runs, lambda r: F.struct(r["start"].alias("a"), r["end"].alias("b"))), F.array(F.struct(F.length(text).alias("a"), F.length(text).alias("b"))))
    ends = F.concat(F.array(F.lit(0)), F.transform(runs, lambda r: r["end"]))
    parts = F.zip_with(keep, ends, lambda k, e: F.substring(F.col(text), e + 1, k["a"] - e))
    return both.select(
        *plain.columns, F.size(terms.words_column(F.col(text))).cast("long").alias("n_words"),
        F.aggregate(runs, F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), runs.alias("runs"),
        (F.when(F.size(runs) == 0, F.col(text)).otherwise(F.array_join(parts, "")) if clean else F.lit(None).cast("string")).alias("clean"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", size: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """docs without what they share with the benchmark: its `spans` are cut out of the texts, or its `documents` go.

    All columns are those of docs; of repeated names the first `text` is the text.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove is 'spans' or 'documents', not {remove!r}")
    found = scan(docs, benchmark, size, remove == "spans", block)
    if remove == "documents":
        found = found.where("n_hit = 0")
    at = docs.columns.index("text")
    out = [F.col("clean") if remove == "spans" and i == at else F.col(f"c{i}") for i in range(len(docs.columns))]
    return found.select(*[c.alias(f"d{i}") for i, c in enumerate(out)]).toDF(*docs.columns)


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 (of the sorted item_ids, joined by commas), contaminated."""
    found = scan(docs.select("doc_id", "text"), benchmark, size, block=block)
    return found.select(
        F.col("c0").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
