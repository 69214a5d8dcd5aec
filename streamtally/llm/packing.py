"""Packing of token sequences by linear grouping.

The large pieces, longest first, are cut into groups of equal cardinality and rounded up to the longest
of their group, which leaves few sizes. For these, configurations that fill a sequence best are found,
each for as many sequences as the sizes' counts allow. The actual pieces take the places of the rounded
ones; then the small pieces go, best fit, into what the large ones leave, and the rest of them into
configurations of their own.

Pieces of one length are interchangeable, so all planning is on counts by length: at most CAPACITY
numbers reach the driver, however many documents there are. A piece finds its place by its length and
its gapless rank among the pieces of its length. No group, length or sequence count is a task's burden.

A null or empty text is one end token. Repeated rows are packed each. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from array import array
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamtally.llm.bpe import PATTERN, Codec
from streamtally.llm.common import gapless, map_texts, written

CAPACITY = 2048
SMALL = 256  # longest small piece
GROUPS = 1024  # of large pieces
END = 0

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


class LibraryCodec(Codec):
    """The same ids with the merges of runs that are not yet known done by a tokenizer library."""

    def __init__(self, path: str):
        super().__init__(path)
        ranks = {self.strings[i]: i for i in self.byte_ids}
        ranks |= {self.strings[m]: m for _, _, m in self.merges}
        order = [m for _, _, m in self.merges]
        if order != sorted(order):
            raise ValueError(f"{path}: ids do not follow the merges' ranks")
        self.library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def run(self, text: str) -> bytes:
        return array(self.code, self.library.encode_ordinary(text)).tobytes()


@lru_cache(maxsize=1)
def codec(path: str) -> LibraryCodec:
    return LibraryCodec(path)


def pieces(df: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Documents as token ids and an end token, cut from the end into pieces of `capacity`; the first may be shorter."""

    def make():
        model = codec(path)

        def work(batch):
            ids_of, rows = batch.column("doc_id").to_pylist(), []
            for doc, text in zip(ids_of, batch.column("text").to_pylist(), strict=True):
                ids = np.frombuffer(model.encode(text).tobytes() + array(model.code, [END]).tobytes(), model.code).astype("<u4")
                start, number = 0, 0
                while start < len(ids):
                    n = (len(ids) - start - 1) % capacity + 1
                    rows.append((doc, number, start, n, zlib.crc32(ids[start : start + n].tobytes())))
                    start, number = start + n, number + 1
            columns = list(zip(*rows, strict=True))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

        return work

    return map_texts(df, ["doc_id", "text"], make, PIECE_SCHEMA)


def best_fill(sizes: list[int], counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(size, how many) with the largest sum up to `room`; among equal sums, few small sizes. Sizes descending."""
    reach, stages = 1, []
    mask = (1 << (room + 1)) - 1
    for s in sizes:
        if s <= room and counts[s]:
            stages.append((s, reach))
            for _ in range(min(counts[s], room // s)):
                grown = (reach | reach << s) & mask
                if grown == reach:
                    break
                reach = grown
            if reach >> room & 1:
                break
    left, out = reach.bit_length() - 1, []
    for s, before in reversed(stages):
        k = 0
        while not before >> (left - k * s) & 1:
            k += 1
        if k:
            out.append((s, k))
            left -= k * s
    return out


def configurations(counts: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Fillings with the number of sequences that take each, until nothing is left. Each has the largest size left."""
    counts, out = dict(counts), []
    sizes = sorted((s for s in counts if counts[s]), reverse=True)
    while sizes:
        top = sizes[0]
        counts[top] -= 1
        more = best_fill(sizes, counts, capacity - top)
        counts[top] += 1
        uses = dict(more)
        uses[top] = uses.get(top, 0) + 1
        times = min(counts[s] // k for s, k in uses.items())
        for s, k in uses.items():
            counts[s] -= k * times
        out.append((sorted(uses.items(), reverse=True), times))
        sizes = [s for s in sizes if counts[s]]
    return out


@dataclass
class Places:
    """Runs of positions: those from start[k] on are in sequences base[k], base[k]+1, ... at slot[k]."""

    start: list[int] = field(default_factory=list)
    base: list[int] = field(default_factory=list)
    slot: list[int] = field(default_factory=list)
    slack: list[int] = field(default_factory=list)  # >= 0: base is a rank among the sequences with this slack


def plan_large(hist: dict[int, int], capacity: int, groups: int) -> tuple[Places, int]:
    """Places by position in the order of falling length; and the number of sequences."""
    lengths = sorted(hist, reverse=True)
    total = sum(hist.values())
    each = max(1, -(-total // groups))
    # Group g holds positions g*each..; it is rounded up to the length at its first position.
    bounds = np.cumsum([hist[x] for x in lengths])
    firsts = np.arange(0, total, each, dtype=object)
    rounded = [lengths[int(np.searchsorted(bounds, int(f), "right"))] for f in firsts]
    counts: dict[int, int] = {}
    next_position: dict[int, int] = {}
    for f, size in zip(firsts, rounded, strict=True):
        next_position.setdefault(size, int(f))
        counts[size] = counts.get(size, 0) + min(each, total - int(f))
    return _assign(configurations(counts, capacity), next_position, 0)


def _assign(found, next_position: dict[int, int], sequence: int) -> tuple[Places, int]:
    rows = []
    for uses, times in found:
        slot = 0
        for size, k in uses:
            for _ in range(k):
                rows.append((next_position[size], sequence, slot))
                next_position[size] += times
                slot += 1
        sequence += times
    rows.sort()
    return Places([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], [-1] * len(rows)), sequence


def plan_small(hist: dict[int, int], slacks: dict[int, int], first: dict[int, int], sequence: int, capacity: int) -> Places:
    """Places of the small pieces: into the sequence with the least room that holds them, then into new sequences."""
    room: dict[int, list[tuple[int, int, int]]] = {s: [(s, 0, n)] for s, n in slacks.items() if n}
    rows, left, turn = [], dict(hist), 1 << 20
    position = dict(first)
    for size in sorted(hist, reverse=True):
        while left[size]:
            fitting = [s for s in room if s >= size and room[s]]
            if not fitting:
                break
            s = min(fitting)
            origin, at, n = room[s].pop()
            m = min(n, left[size])
            rows.append((position[size], at, turn, origin))
            position[size] += m
            left[size] -= m
            turn += 1
            room.setdefault(s - size, []).append((origin, at, m))
            if n > m:
                room[s].append((origin, at + m, n - m))
    rest, _ = _assign(configurations(left, capacity), position, sequence)
    rows += list(zip(rest.start, rest.base, rest.slot, rest.slack, strict=True))
    rows.sort()
    return Places(*map(list, zip(*rows, strict=True))) if rows else Places()


def _placed(ranked: DataFrame, places: Places, first: dict[int, int]) -> DataFrame:
    """Adds base (sequence, or rank among the sequences of this slack), slot, slack to rows with length and rank."""
    start, base, slot, slack = (np.array(x, np.int64) for x in (places.start, places.base, places.slot, places.slack))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                length = batch.column("length").to_numpy()
                position = np.vectorize(first.__getitem__, otypes=[np.int64])(length) + batch.column("rank").to_numpy()
                k = np.searchsorted(start, position, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in columns), pa.array(base[k] + position - start[k]), pa.array(slot[k]), pa.array(slack[k])],
                    [*columns, "base", "slot", "slack"],
                )

    return ranked.select(*columns, "rank").mapInArrow(run, PIECE_SCHEMA + ", base long, slot long, slack long")


def _first_positions(hist: dict[int, int]) -> dict[int, int]:
    out, at = {}, 0
    for x in sorted(hist, reverse=True):
        out[x] = at
        at += hist[x]
    return out


def pack(cut: DataFrame, capacity: int = CAPACITY, small: int = SMALL, groups: int = GROUPS) -> DataFrame:
    """Adds sequence_id and offset to the rows of `pieces`."""
    order = [F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("doc_id"), F.col("piece"), F.col("ids_crc32")]
    ranked = written(gapless(written(cut, "pieces"), ["length"], order, "rank"), "pieces")
    hist = {r["length"]: r["n"] for r in ranked.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= capacity rows
    large = {x: n for x, n in hist.items() if x > small}
    little = {x: n for x, n in hist.items() if x <= small}
    places, sequences = plan_large(large, capacity, groups) if large else (Places(), 0)
    laid = _placed(ranked.where(F.col("length") > small), places, _first_positions(large)).select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("base").alias("sequence_id"), "slot"
    )
    laid = written(laid, "large-pieces")
    used = laid.groupBy("sequence_id").agg((F.lit(capacity) - F.sum("length")).alias("slack")).where("slack > 0")
    rooms = written(gapless(used, ["slack"], [F.col("sequence_id")], "rank"), "rooms")
    slacks = {r["slack"]: r["n"] for r in rooms.groupBy("slack").agg(F.count(F.lit(1)).alias("n")).collect()}  # < capacity rows
    first = _first_positions(little)
    fill = plan_small(little, slacks, dict(first), sequences, capacity)
    added = _placed(ranked.where(F.col("length") <= small), fill, first)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "slot"]
    fresh = added.where("slack < 0").withColumnRenamed("base", "sequence_id").select(columns)
    into = added.where("slack >= 0").join(rooms.withColumnRenamed("rank", "base"), ["slack", "base"]).select(columns)
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    everything = laid.select(columns).union(fresh).union(into)
    return everything.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).drop("slot")
