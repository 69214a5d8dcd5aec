"""Near-duplicate documents by an LSH forest of MinHash signatures, confirmed on the full sets.

Each distinct set of word shingles has a signature of TREES x DEPTH values. A tree is an order of all
signatures, each tree rotated by DEPTH values, so the trees' first values are independent. Sets that
share a tree's first DEPTH values are a region. In a region, the pairs whose signatures agree in
CANDIDATE of the values are candidates. A region of more than REGION sets, or at the end of a task's range,
counts as connected as a whole and is left to the comparison below; a greater depth there would lose links. Candidates only say which sets may be linked at all: the sets connected
by them are brought to one place, each once, and compared in full there, so what is linked does not
depend on which candidates were found in which tree.

A group with more than `max_docs` sets or `max_shingles` shingles is not compared in one place: its
sets are dealt to blocks, a few of them are compared with every block, and then those that are not in
the largest class so far. A block holds its own sets only; the queries pass by in slices. No link is left
out; without a class that holds most of a group, the texts that are moved grow with the square of its size.

Documents without words have an empty set and are linked with nothing. A null doc_id is linked with
nothing. Rows that repeat a doc_id count as one document. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamtally.llm.common import map_texts, partitions, text_batches, written
from streamtally.llm.components import components
from streamtally.llm.hashes import mixed, shingle_sets

TREES, DEPTH = 21, 3
VALUES = TREES * DEPTH
CANDIDATE = 33  # of VALUES; a pair of similarity 0.8 agrees in fewer once in ten million
REGION = 512
PIECE = 512 << 10
CENTRES = 16
QUERIES = 4  # times max_docs: queries of a block in one place


@dataclass(frozen=True)
class Limits:
    max_docs: int = 3000
    max_shingles: int = 3_000_000


def _bytes(text: str | None) -> bytes:
    return text.encode().lower() if text else b""  # lower() of bytes: A-Z only


def _sum(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, at) if len(at) else np.zeros(0, values.dtype)


def signatures(df: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, two 64-bit sums that name the set, and the signature (null without shingles)."""
    factors = np.random.default_rng(42).integers(1, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def make():
        def work(batch):
            texts = [_bytes(t) for t in batch.column("text").to_pylist()]
            counts, first, second, sigs = [], [], [], []
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) < PIECE):
                    size += len(texts[end])
                    end += 1
                sets = shingle_sets(texts[at:end], k)
                at = end
                n = np.array([len(s) for s in sets])
                full = np.flatnonzero(n)
                values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                starts = np.concatenate([[0], np.cumsum(n[full])[:-1]]).astype(np.int64) if len(full) else np.zeros(0, np.int64)
                sig = np.zeros((len(full), VALUES), ">u4")
                for j in range(VALUES if len(full) else 0):
                    sig[:, j] = np.minimum.reduceat((values * factors[j]) >> np.uint64(32), starts)
                names = np.zeros((2, len(sets)), np.uint64)
                names[0, full], names[1, full] = _sum(mixed(values), starts), _sum(mixed(values + np.uint64(0x1234567)), starts)
                counts.append(n)
                first.append(names[0].view(np.int64))
                second.append(names[1].view(np.int64))
                rows: list[bytes | None] = [None] * len(sets)
                for i, row in zip(full.tolist(), sig, strict=True):
                    rows[i] = row.tobytes()
                sigs += rows
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(np.concatenate(x).astype(np.int64)) for x in (counts, first, second)), pa.array(sigs, pa.binary())],
                ["doc_id", "n_shingles", "h1", "h2", "sig"],
            )

        return work

    return map_texts(df, ["doc_id", "text"], make, "doc_id long, n_shingles long, h1 long, h2 long, sig binary")


def forest(reps: DataFrame) -> DataFrame:
    """tree, prefix (its first DEPTH values), rest (one byte of every value in the tree's order), id."""

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint8).reshape(n, VALUES, 4)
            ids = batch.column("id")
            for tree in range(TREES):
                turned = np.roll(sig, -tree * DEPTH, axis=1)
                prefix = np.ascontiguousarray(turned[:, :DEPTH]).reshape(n, -1)
                rest = np.ascontiguousarray(turned[:, :, 3])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, tree, np.int32)), *(pa.array([r.tobytes() for r in x], pa.binary()) for x in (prefix, rest)), ids],
                    ["tree", "prefix", "rest", "id"],
                )

    return reps.select("id", "sig").mapInArrow(run, "tree int, prefix binary, rest binary, id long")


def _classes(rest: np.ndarray, ids: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect the rows whose signatures agree in CANDIDATE values, directly or by way of others."""
    n = len(ids)
    label = np.arange(n)
    for i in range(n - 1):
        alike = np.flatnonzero((rest[i + 1 :] == rest[i]).sum(axis=1) >= CANDIDATE) + i + 1
        if len(alike):
            met = np.unique(label[np.append(alike, i)])
            if len(met) > 1:
                label[np.isin(label, met)] = met[0]
    out = []
    for c in np.unique(label):
        members = ids[label == c]
        out += [(int(members.min()), int(m)) for m in members if m != members.min()]
    return out


def candidate_edges(reps: DataFrame) -> DataFrame:
    """a, b: edges that connect all sets that may be linked.

    Each tree's order is dealt to tasks by ranges of the whole order, so that a large region is spread
    over tasks; the regions at a task's ends are joined by one edge afterwards.
    """
    order = ["tree", "prefix", "rest", "id"]

    def run(batches):
        edges: list[tuple] = []
        held: dict | None = None  # the region still growing: tree, prefix, its last rows, its first id

        def close(part, whole: bool) -> None:
            rest, ids = part["rest"], part["ids"]
            while len(ids) > REGION or (whole and len(ids)):
                cut = len(ids)
                if cut > REGION:
                    differs = rest[1:REGION] != rest[: REGION - 1]
                    shared = np.where(differs.any(axis=1), differs.argmax(axis=1), VALUES)
                    cut = REGION // 2 + int(shared[REGION // 2 - 1 :].argmin())
                    part["split"] = True
                if part["split"]:
                    edges.extend((None, None, part["first"], int(x)) for x in ids[:cut])
                elif cut > 1:
                    edges.extend((None, None, a, b) for a, b in _classes(rest[:cut], ids[:cut]))
                rest, ids = rest[cut:], ids[cut:]
            part["rest"], part["ids"] = rest, ids

        def border(part) -> None:
            part["split"] = True  # it may go on in another task
            edges.append((part["tree"], part["prefix"], part["first"], None))

        def flush():
            if not edges:
                return
            columns = list(zip(*edges, strict=True))
            edges.clear()
            kinds = [pa.int32(), pa.binary(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["tree", "prefix", "a", "b"])

        start = True
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            trees = batch.column("tree").to_numpy()
            prefix = np.frombuffer(b"".join(batch.column("prefix").to_pylist()), np.uint8).reshape(n, -1)
            rest = np.frombuffer(b"".join(batch.column("rest").to_pylist()), np.uint8).reshape(n, -1)
            ids = batch.column("id").to_numpy()
            new = np.concatenate([[True], (trees[1:] != trees[:-1]) | (prefix[1:] != prefix[:-1]).any(axis=1)])
            if held and held["tree"] == trees[0] and held["prefix"] == prefix[0].tobytes():
                new[0] = False
            heads = np.flatnonzero(new)
            upto = int(heads[0]) if len(heads) else n
            if upto:
                held["rest"], held["ids"] = np.concatenate([held["rest"], rest[:upto]]), np.concatenate([held["ids"], ids[:upto]])
                close(held, False)
            ends = np.append(heads[1:], n)
            for k in np.flatnonzero((ends - heads > 1) | (np.arange(len(heads)) == len(heads) - 1) | (start & (np.arange(len(heads)) == 0))).tolist():
                a, b = int(heads[k]), int(ends[k])
                if held:
                    close(held, True)
                held = {"tree": int(trees[a]), "prefix": prefix[a].tobytes(), "rest": rest[a:b], "ids": ids[a:b], "split": False, "first": int(ids[a])}
                if start:
                    border(held)
                    start = False
                close(held, False)
            yield from flush()
        if held:
            border(held)
            close(held, True)
            yield from flush()

    trees = forest(reps).repartitionByRange(partitions(reps.sparkSession), *order).sortWithinPartitions(*order)
    found = written(trees.select(*order).mapInArrow(run, "tree int, prefix binary, a long, b long"), "candidates")
    inside = found.where("b is not null").select("a", "b")
    across = found.where("b is null").select("tree", "prefix", "a").withColumn("b", F.min("a").over(Window.partitionBy("tree", "prefix")))
    return inside.union(across.select("a", "b"))


class Sets:
    """Full sets, with an index from each shingle to the sets that hold it."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.values, codes = np.unique(np.concatenate(sets), return_inverse=True)
        owners = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(codes, kind="stable")
        self.postings = owners[order]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(self.values)))])

    def linked(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Which sets reach the similarity with this one."""
        at = np.minimum(np.searchsorted(self.values, query), len(self.values) - 1)
        at = at[self.values[at] == query]
        a, n = self.first[at], self.first[at + 1] - self.first[at]
        skip = np.repeat(a - np.concatenate([[0], np.cumsum(n)[:-1]]), n) if len(at) else np.zeros(0, np.int64)
        both = np.bincount(self.postings[np.arange(len(skip)) + skip], minlength=len(self.sizes))
        return 100 * both >= percent * (self.sizes + len(query) - both)


def link_all(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Smallest id reachable by links, for each."""
    n = len(ids)
    if n == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        linked = 100 * both >= percent * (len(sets[0]) + len(sets[1]) - both)
        return np.full(2, ids.min()) if linked or ids[0] == ids[1] else ids.copy()
    index, label = Sets(sets), np.unique(ids, return_inverse=True)[1]

    def absorb(i: int) -> None:
        met = np.unique(label[index.linked(sets[i], percent)])
        if len(met) > 1:
            label[np.isin(label, met)] = met[0]

    reached = np.zeros(n, bool)
    for i in range(n):  # stars first: most of a group hangs on a few
        if not reached[i]:
            hit = index.linked(sets[i], percent)
            reached |= hit
            met = np.unique(label[hit])
            label[np.isin(label, met)] = met[0]
    member = int(np.flatnonzero(label == np.bincount(label).argmax())[0])
    for i in range(n):  # whoever is outside the largest class meets all; inside it nothing is left to find
        if label[i] != label[member]:
            absorb(i)
    out = np.empty(n, ids.dtype)
    for c in np.unique(label):
        out[label == c] = ids[label == c].min()
    return out


def _groups(batches, key: str):
    """Rows of each value of the key, of batches that are sorted by it, as (value, list of record batches)."""
    held, parts = None, []
    for batch in batches:
        values = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)], strict=True):
            if a == b:
                continue
            if parts and values[a] != held:
                yield held, parts
                parts = []
            held = values[a]
            parts.append(batch.slice(a, b - a))
    if parts:
        yield held, parts


def _column(parts: list[pa.RecordBatch], name: str) -> list:
    return [v for p in parts for v in p.column(name).to_pylist()]


def confirm(texts: DataFrame, k: int, percent: int) -> DataFrame:
    """id, label of the rows (group, id, text) of groups that fit in one place."""

    def run(batches):
        for _, parts in _groups(batches, "group"):
            ids = np.array(_column(parts, "id"), np.int64)
            label = link_all(ids, shingle_sets([_bytes(t) for t in _column(parts, "text")], k), percent)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(label)], ["id", "label"])

    dealt = texts.select("group", "id", "text").repartition("group").sortWithinPartitions("group")
    return dealt.mapInArrow(run, "id long, label long")


def links_of_blocks(batches, k: int, percent: int):
    """Links (a, b) of rows (block, id, text, query) in order of block and query: a block's own sets are held, its queries are not."""
    held, parts, index = None, [], None
    for batch in text_batches(batches):
        block, query = batch.column("block").to_numpy(), batch.column("query").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((block[1:] != block[:-1]) | (query[1:] != query[:-1])) + 1
        links = []
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)], strict=True):
            part = batch.slice(a, b - a)
            if block[a] != held:
                held, parts, index = block[a], [], None
            if not query[a]:
                parts.append(part)
                continue
            if index is None:
                if not parts:
                    continue
                own = np.array(_column(parts, "id"), np.int64)
                index = Sets(shingle_sets([_bytes(t) for t in _column(parts, "text")], k))
                label = np.arange(len(own))  # what the links found so far connect
                parts = []
            for me, asked in zip(part.column("id").to_pylist(), shingle_sets([_bytes(t) for t in part.column("text").to_pylist()], k), strict=True):
                hit = np.flatnonzero(index.linked(asked, percent))
                classes, firsts = np.unique(label[hit], return_index=True)
                links += [(me, int(own[hit[f]])) for f in firsts]
                if len(classes):
                    label[np.isin(label, classes)] = classes[0]
        if links:
            a, b = zip(*links, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def block_links(rows: DataFrame, k: int, percent: int) -> DataFrame:
    """a, b: links between the queries and the others of each block, rows (block, id, text, query); of the
    links only as many as connect the same sets."""
    dealt = rows.select("block", "id", "text", "query").repartition("block").sortWithinPartitions("block", "query")
    return dealt.mapInArrow(lambda batches: links_of_blocks(batches, k, percent), "a long, b long")


def _blocks(texts: DataFrame, sizes: DataFrame, asking: DataFrame, limits: Limits) -> DataFrame:
    """Every row in one block of its group, and the group's queries, rows (group, id), in all of its blocks. A block of
    many queries is given out several times, each time for another slice of them."""
    wanted = sizes.select("group", F.greatest(F.ceil(F.col("docs") / limits.max_docs), F.ceil(F.col("shingles") / limits.max_shingles)).cast("int").alias("n"))
    slices = asking.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / (QUERIES * limits.max_docs)).cast("int").alias("slices"))
    wanted = wanted.join(slices, "group")
    number, slice_of = F.pmod(F.xxhash64("id"), F.col("n")).cast("int"), F.pmod(F.xxhash64(F.lit(7), "id"), F.col("slices")).cast("int")
    placed = texts.join(wanted, "group").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    own = placed.select(F.xxhash64("group", number, "slice").alias("block"), "id", "text", F.lit(False).alias("query"))
    asked = texts.join(asking, ["group", "id"]).join(wanted, "group").withColumn("number", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return own.union(asked.select(F.xxhash64("group", F.col("number"), slice_of), "id", "text", F.lit(True)))


def _large(texts: DataFrame, sizes: DataFrame, k: int, percent: int, limits: Limits) -> DataFrame:
    """id, label of the rows of groups too large for one place."""
    texts = written(texts, "large-groups")
    # A centre is the first of one of CENTRES parts of its group, so no task orders a whole group.
    firsts = texts.groupBy("group", F.pmod(F.xxhash64("id"), F.lit(CENTRES)).alias("part")).agg(F.min(F.struct(F.xxhash64("id").alias("h"), "id")).alias("c"))
    centres = firsts.select("group", "c.id")
    links = written(block_links(_blocks(texts, sizes, centres, limits), k, percent), "links")
    nodes = texts.select("group", "id").distinct()
    so_far = nodes.join(components(links), "id", "left").withColumn("label", F.coalesce("label", "id"))
    labelled = written(so_far.select("group", "id", "label"), "labels")
    counts = labelled.groupBy("group", "label").count()
    largest = counts.groupBy("group").agg(F.max(F.struct("count", "label")).alias("m")).select("group", F.col("m.label").alias("main"))
    outside = labelled.join(largest, "group").where("label <> main").select("group", "id")
    more = written(block_links(_blocks(texts, sizes, outside, limits), k, percent), "links")
    found = components(links.union(more))
    return nodes.select("id").distinct().join(found, "id", "left").select("id", F.coalesce("label", "id").alias("label"))


def near_duplicates(df: DataFrame, percent: int = 80, k: int = 5, limits: Limits | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included), kept.

    Two documents are linked if 100 * intersection >= percent * union of their sets of k-word shingles.
    """
    limits = limits or Limits()
    docs = written(signatures(df, k), "signatures")
    named = docs.where("n_shingles > 0 and doc_id is not null")
    sets = named.groupBy("h1", "h2", "n_shingles").agg(F.min(F.struct("doc_id", "sig")).alias("m"))
    reps = written(sets.select("h1", "h2", "n_shingles", F.col("m.doc_id").alias("id"), F.col("m.sig").alias("sig")), "sets")

    groups = written(components(candidate_edges(reps)), "groups").select("id", F.col("label").alias("group"))
    members = groups.join(reps.select("id", "n_shingles"), "id")
    sizes = written(members.groupBy("group").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_shingles").alias("shingles")), "sizes")
    large = sizes.where((F.col("docs") > limits.max_docs) | (F.col("shingles") > limits.max_shingles))
    texts = df.select(F.col("doc_id").alias("id"), "text").where("text is not null").join(groups, "id")
    if large.isEmpty():
        labels = confirm(texts, k, percent)
    else:
        texts = written(texts, "candidate-texts")
        small = confirm(texts.join(large.select("group"), "group", "left_anti"), k, percent)
        labels = small.union(_large(texts.join(large.select("group"), "group"), large, k, percent, limits))
    labels = labels.groupBy("id").agg(F.min("label").alias("label"))
    of_sets = reps.select("h1", "h2", "n_shingles", "id").join(labels, "id", "left").select("h1", "h2", "n_shingles", F.coalesce("label", "id").alias("label"))
    joined = docs.drop("sig").join(of_sets, ["h1", "h2", "n_shingles"], "left")
    own = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("label")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))
