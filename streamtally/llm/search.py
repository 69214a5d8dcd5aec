"""Ranked lexical search: the best documents of each query, through posting lists blocked by document similarity.

A term's posting list is the documents that hold it. Where a list has to be read, its documents are clustered by
the inner product of their impact vectors with a few of them, and each cluster (block) stores its summary, the
coordinatewise maximum of its documents' vectors. A query bounds each block by the inner product with its summary;
a block is read only if that bound reaches the score the query's last place has so far, so nothing is lost. The
same bound with the maxima of the whole unit tells which lists have to be blocked at all: those of common words
rarely have to.

How it is spread: one pass over the texts keeps of every document its length and its counts of the queries' terms,
written as a table. Documents are sorted by their heaviest terms and dealt in ranges, so similar ones come into one
task and a hot text or source is cut like any other; a task works them off in units of UNIT_POSTINGS postings. Each
unit returns at most `top` documents a query, merged by one ranking. A hashed part of the documents is searched
first: the score of its `top`-th document is a floor for all others. It only prunes; every document is searched.

What is broadcast has a bound: queries are taken in blocks of QUERY_TERMS distinct (query, term) pairs, one pass
over the texts each, whatever their number. A single query with more terms is a block of its own.

Scores are whole numbers: weight = floor(1000 ln((2N + 2) / (2 df + 1))) of a term times
(10^9 tf) div (1000 tf + 12 m), m = 75 + (25 n N) div L, summed over the query's terms, repeats included.

Defined results: null and empty texts have no terms and are never returned; documents of score 0 neither. Ties are
in ascending doc_id, rows without id last; rows that share an id are documents of their own. Each distinct
(item_id, text) row of the queries is ranked by itself; a query without terms has no rows. An empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamtally.llm import terms
from streamtally.llm.common import written

TOP = 20
QUERY_TERMS = 200_000
UNIT_POSTINGS = 400_000
LIST_BLOCK = 32  # documents a block holds on average
MAX_PIVOTS = 64
SEED_SHARE = 32  # one document in so many is searched first
NO_ID = np.iinfo(np.int64).max

FORWARD = "doc_id long, n long, terms array<int>, tfs array<int>"
FORWARD_COLUMNS = ["doc_id", "n", "terms", "tfs"]
HEAVY = ["heavy_1", "heavy_2", "heavy_3"]


@dataclass
class Queries:
    """A block of queries: term numbers and how often each stands in the query, one query after the other."""

    numbers: list[int]
    vocabulary: list[str]
    first: np.ndarray  # places of the queries in the two below, and their end
    term: np.ndarray
    count: np.ndarray


def query_terms(queries: DataFrame) -> DataFrame:
    """item, text_hash, term, count: the terms of each distinct (item_id, text)."""
    split = queries.select(F.col("item_id").alias("item"), F.sha2("text", 256).alias("digest"), "text").where("text is not null").distinct()
    each = split.select("item", "digest", F.explode(terms.words_column(F.col("text"))).alias("term"))
    return each.groupBy("item", "digest", "term").agg(F.count(F.lit(1)).alias("count"))


def _blocks(found: DataFrame, limit: int) -> list[tuple[DataFrame, list]]:
    """The queries with their terms, in blocks of about `limit` rows: (rows with their query's number, numbers -> item_id)."""
    sizes = found.groupBy("item", "digest").agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // limit))
    block = F.pmod(F.xxhash64("item", "digest"), F.lit(blocks))
    return [found.where(block == b) for b in range(blocks)] if total else []


def _gathered(rows: DataFrame) -> tuple[Queries, list]:
    """One block's queries, and their item_ids by number."""
    table = rows.toArrow().to_pylist()  # about QUERY_TERMS rows
    table.sort(key=lambda r: (r["digest"], r["item"] is None, r["item"] or 0, r["term"]))
    vocabulary = sorted({r["term"] for r in table})
    place = {t: i for i, t in enumerate(vocabulary)}
    items, first, seen = [], [], None
    for k, r in enumerate(table):
        if (r["item"], r["digest"]) != seen:
            seen = (r["item"], r["digest"])
            items.append(r["item"])
            first.append(k)
    numbers = np.array([place[r["term"]] for r in table], np.int64)
    counts = np.array([r["count"] for r in table], np.int64)
    return Queries(list(range(len(items))), vocabulary, np.array([*first, len(table)]), numbers, counts), items


def forward(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """doc_id, n (terms with repeats), terms (numbers in the vocabulary, ascending), tfs of every document."""
    sent, name = docs.sparkSession.sparkContext.broadcast(vocabulary), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, numbers = _lookup(name, sent)
        size = len(numbers) + 1
        for batch in terms.small_batches(batches):
            w = terms.words(batch.column("text"))
            at, place = known.find(w.hashes())
            keys, tf = np.unique(w.owner[at] * size + numbers[place], return_counts=True)
            ends = np.searchsorted(keys // size, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (keys % size, tf)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(w.first)), *lists], FORWARD_COLUMNS)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, FORWARD)


_kept: dict[str, object] = {}


def _once(name: str, make):
    """Built once per Python worker; what an earlier step left goes."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]


def _lookup(name: str, sent: Broadcast) -> tuple[terms.HashSet, np.ndarray]:
    """The vocabulary's hashes, and the term number of each in hash order."""

    def make():
        hashes = terms.words(pa.array(sent.value, pa.string())).hashes()
        known = terms.HashSet(hashes)
        if len(known.sorted) != len(hashes):
            raise ValueError("two terms of the queries have one 64-bit hash")
        return known, np.argsort(hashes)

    return _once(name, make)


@dataclass
class Model:
    """What every unit needs of the corpus and the queries. `coefficient` is weight times count, heaviest first in a query."""

    documents: int
    length: int
    postings: int
    weight: np.ndarray
    first: np.ndarray
    term: np.ndarray
    coefficient: np.ndarray
    floor: np.ndarray  # least score that can still be among a query's best
    top: int

    def impacts(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 75 + (25 * n * self.documents) // max(self.length, 1)
        return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def weights(documents: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def model_of(table: DataFrame, queries: Queries, top: int) -> Model:
    """Corpus counts over all documents: their number and length, and how many hold each term."""
    total = table.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.sum("n").alias("length"), F.sum(F.size("terms")).alias("postings")).first()
    df = np.zeros(len(queries.vocabulary), np.int64)
    # One row a term of the vocabulary.
    for r in table.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[r["t"]] = r["count"]
    weight = weights(total["documents"], df)
    coefficient = weight[queries.term] * queries.count
    query = np.repeat(np.arange(len(queries.first) - 1), np.diff(queries.first))
    order = np.lexsort((queries.term, -weight[queries.term], query))
    floor = np.ones(len(queries.first) - 1, np.int64)
    return Model(total["documents"], total["length"] or 0, total["postings"] or 0, weight, queries.first, queries.term[order], coefficient[order], floor, top)


class Unit:
    """Documents of one unit with their impact vectors, and the blocked lists of those terms that queries have to read."""

    def __init__(self, model: Model, ids: np.ndarray, n: np.ndarray, ends: np.ndarray, term: np.ndarray, tf: np.ndarray):
        self.model, self.ids, self.ends, self.term = model, ids, ends, term
        lengths = np.diff(ends)
        self.value = model.impacts(tf, np.repeat(n, lengths))
        self.size = len(model.weight)
        self.summary = np.zeros(self.size, np.int64)
        np.maximum.at(self.summary, term, self.value)
        order = np.argsort(term, kind="stable")
        self.holders = np.repeat(np.arange(len(ids)), lengths)[order]
        self.list_first = np.searchsorted(term[order], np.arange(self.size + 1))
        self.blocks: dict[int, tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]] = {}
        self.read = self.skipped = self.scored = 0  # blocks, blocks, documents

    def rows(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the documents' entries, and where each document's begin."""
        lengths = self.ends[docs + 1] - self.ends[docs]
        begin = np.concatenate([[0], np.cumsum(lengths)])
        return np.repeat(self.ends[docs] - begin[:-1], lengths) + np.arange(begin[-1]), begin

    def blocked(self, t: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """The blocks of a term's list and their summaries, sparse: (documents by block, places of the blocks in
        the next two, terms, maxima). Built when the first query has to read the list."""
        if t in self.blocks:
            return self.blocks[t]
        docs = self.holders[self.list_first[t] : self.list_first[t + 1]]
        entries, begin = self.rows(docs)
        pivots = min(MAX_PIVOTS, -(-len(docs) // LIST_BLOCK))
        member = np.zeros(len(docs), np.int64)
        if pivots > 1:
            chosen = docs[np.linspace(0, len(docs) - 1, pivots).astype(np.int64)]
            nearest = np.full(len(docs), -1.0)
            scaled = (self.value * self.model.weight[self.term]).astype(np.float64)
            for p, d in enumerate(chosen.tolist()):  # one dense vector at a time
                vector = np.zeros(self.size)
                own = slice(self.ends[d], self.ends[d + 1])
                vector[self.term[own]] = scaled[own] / (np.sqrt(np.sum(scaled[own] ** 2)) or 1.0)
                product = np.add.reduceat(vector[self.term[entries]] * scaled[entries], begin[:-1])
                closer = product > nearest
                member[closer], nearest[closer] = p, product[closer]
        present, member = np.unique(member, return_inverse=True)
        key = np.repeat(member, np.diff(begin)) * self.size + self.term[entries]
        order = np.argsort(key, kind="stable")
        distinct, at = np.unique(key[order], return_index=True)
        highest = np.maximum.reduceat(self.value[entries][order], at)
        places = np.searchsorted(distinct // self.size, np.arange(len(present) + 1))
        split = [docs[member == b] for b in range(len(present))]
        self.blocks[t] = split, places, distinct % self.size, highest
        return self.blocks[t]

    def search(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, documents, scores): at most `top` a query, all that can be among its best."""
        m = self.model
        # What the terms from this one on can add up to, by the unit's maxima; heavier ones come first.
        most = m.coefficient * self.summary[m.term]
        up_to = np.concatenate([[0], np.cumsum(most)])
        rest = np.repeat(up_to[m.first[1:]], np.diff(m.first)) - up_to[:-1]
        for q in np.flatnonzero(np.maximum.reduceat(rest, m.first[:-1]) >= m.floor).tolist() if len(m.term) else []:
            a, b = int(m.first[q]), int(m.first[q + 1])
            floor, best, scores = int(m.floor[q]), np.zeros(0, np.int64), np.zeros(0, np.int64)
            seen = np.zeros(len(self.ids), bool)
            coefficient = np.zeros(self.size, np.int64)
            coefficient[m.term[a:b]] = m.coefficient[a:b]
            ahead = coefficient.copy()  # of this term and lighter ones: others' lists have been read
            for j in range(a, b):
                t = int(m.term[j])
                if rest[j] < floor:
                    break
                if self.list_first[t] < self.list_first[t + 1]:
                    split, places, of, highest = self.blocked(t)
                    bounds = np.add.reduceat(ahead[of] * highest, places[:-1])
                    for k in np.argsort(-bounds, kind="stable").tolist():
                        if bounds[k] < floor:
                            self.skipped += int(np.sum(bounds < floor))
                            break
                        self.read += 1
                        docs = split[k][~seen[split[k]]]
                        if not len(docs):
                            continue
                        seen[docs] = True
                        self.scored += len(docs)
                        entries, begin = self.rows(docs)
                        got = np.add.reduceat(coefficient[self.term[entries]] * self.value[entries], begin[:-1])
                        able = got >= floor
                        best, scores = np.concatenate([best, docs[able]]), np.concatenate([scores, got[able]])
                        if len(best) >= m.top:
                            order = np.lexsort((self.ids[best], -scores))[: m.top]
                            best, scores = best[order], scores[order]
                            floor = max(floor, int(scores[-1]))
                ahead[t] = 0
            if len(best):
                yield q, best, scores


def _keyed(table: DataFrame, model: Model) -> DataFrame:
    """The rows with their three heaviest terms, by which similar documents come together."""
    sent = table.sparkSession.sparkContext.broadcast(model.weight)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries = batch.column("terms")
            term, ends = entries.flatten().to_numpy(), entries.offsets.to_numpy().astype(np.int64)
            ends -= ends[0]
            order = np.lexsort((term, -sent.value[term], np.repeat(np.arange(batch.num_rows), np.diff(ends))))
            keys = []
            for k in range(len(HEAVY)):
                some = np.diff(ends) > k
                key = np.full(batch.num_rows, -1, np.int32)
                key[some] = term[order[ends[:-1][some] + k]]
                keys.append(pa.array(key))
            yield pa.RecordBatch.from_arrays([*batch.columns, *keys], [*FORWARD_COLUMNS, *HEAVY])

    return table.mapInArrow(run, FORWARD + "".join(f", {h} int" for h in HEAVY))


def _units(batches: Iterator[pa.RecordBatch], postings: int) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of about so many postings; a document is never cut."""
    held, size = [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            ends = batch.column("terms").slice(at).offsets.to_numpy().astype(np.int64)
            step = max(1, int(np.searchsorted(ends - ends[0], postings - size, "right")) - 1)
            step = min(step, batch.num_rows - at)
            held.append(batch.slice(at, step))
            size += int(ends[step] - ends[0]) + step
            at += step
            if size >= postings:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _found(table: DataFrame, model: Model, postings: int) -> DataFrame:
    """query, doc_id, score of the documents that every unit of the rows returns."""
    sent = table.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _units(batches, postings):
            ids = rows.column("doc_id")
            plain = ids.fill_null(int(NO_ID)).to_numpy()
            entries = rows.column("terms")
            ends = entries.offsets.to_numpy().astype(np.int64)
            term = entries.flatten().to_numpy().astype(np.int64)
            tf = rows.column("tfs").flatten().to_numpy().astype(np.int64)
            unit = Unit(sent.value, plain, rows.column("n").to_numpy(), ends - ends[0], term, tf)
            for q, docs, scores in unit.search():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(docs), q, np.int32)), ids.take(pa.array(docs)), pa.array(scores)], ["query", "doc_id", "score"]
                )

    return table.mapInArrow(run, "query int, doc_id long, score long")


def _best(found: DataFrame, top: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", place).where(F.col("rank") <= top)


def search(
    docs: DataFrame, queries: DataFrame, top: int = TOP, query_terms_limit: int = QUERY_TERMS, unit_postings: int = UNIT_POSTINGS
) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` best documents of each (item_id, text) of the queries."""
    spark = docs.sparkSession
    kind = queries.schema["item_id"].dataType.simpleString()
    out = None
    for rows in _blocks(written(query_terms(queries), "query-terms"), query_terms_limit):
        block, items = _gathered(rows)
        if not items:
            continue
        table = written(forward(docs, block.vocabulary), "forward")
        model = model_of(table, block, top)
        held = table.where(F.size("terms") > 0)
        early = held.where(F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(SEED_SHARE)) == 0)
        last = _best(_found(early, model, unit_postings), top).where(F.col("rank") == top)
        for r in last.collect():  # one row a query of the block
            model.floor[r["query"]] = max(1, r["score"])
        tasks = max(1, -(-model.postings // unit_postings))
        dealt = _keyed(held, model).repartitionByRange(tasks, *HEAVY, F.xxhash64("doc_id", "n")).sortWithinPartitions(*HEAVY)
        ranked = _best(_found(dealt.drop(*HEAVY), model, unit_postings), top)
        names = spark.createDataFrame(list(enumerate(items)), f"query int, item_id {kind}")
        named = ranked.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")
        out = named if out is None else out.unionByName(named)
    return out if out is not None else spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")

