"""Exact top-k search by BM25: block-max WAND over an inverted index in shards.

The index is a table of shards of some thousand documents, each with its terms' postings in document
order. Statistics are global: document counts of terms are summed over all shards before any
scoring, so a score does not depend on the shard. Queries are broadcast in batches; at a shard, a query
of few terms skips what block maxima rule out, and queries of many, which bounds hardly prune, add up all postings of their terms, many queries
at once. Scores are rounded to 9 decimals, so equal documents tie whatever the order of sums. A batch of queries goes to ``GROUPS`` tasks, each of which takes its share of the shards one after
the other, carries every query's best k and their least score from shard to shard, and sends one list for each query at the end. The lists
are merged, which is exact, as every task returns its own best k. So the lists grow with the queries alone, and a bigger cluster runs
more batches at once (``at_once``).

A term that all documents hold is one entry for each shard, so no term's postings meet in a task.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written
from .textops import U, flat, planes, slices, trim, unplanes, words

#: Postings and documents of a shard, at most (a longer single document makes a larger one).
POSTINGS, DOCUMENTS = 1_000_000, 8192
BLOCK = 64
#: Up to so many terms a query is searched by block-max WAND; with more, which bounds hardly prune, all postings are added up.
FEW = 16
#: (query, term) pairs of a batch of queries, which is broadcast to all shards.
ASKED = 2_000_000
#: Terms of more than one in so many of a shard's documents are rows of a matrix; the others are lists.
DENSE = 6
#: Scores (queries times documents) that are added up at once.
CELLS = 300_000
#: Tasks of a batch of queries.
GROUPS = 32
_INDEX = "shard long, documents long, words long, ids binary, lengths binary, terms binary, held binary, places binary, times binary"


def _bags(ids: list, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(id, words, distinct terms in order, their frequencies) of each document with an id."""
    data, at = flat(texts)
    for i, j in slices(at):
        w, r = words(data[at[i] : at[j]], at[i : j + 1] - at[i])
        for d in range(j - i):
            if ids[i + d] is not None:
                u, n = np.unique(w[r[d] : r[d + 1]], return_counts=True)
                yield ids[i + d], int(r[d + 1] - r[d]), u, n


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard = TaskContext.get().partitionId() << 32
    held: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    size = 0

    def made() -> pa.RecordBatch:
        nonlocal shard, size
        held.sort(key=lambda x: x[0])
        place = np.repeat(np.arange(len(held)), [len(x[2]) for x in held])
        term, times = np.concatenate([x[2] for x in held]), np.concatenate([x[3] for x in held])
        order = np.argsort(term, kind="stable")
        term, place, times = term[order], place[order], times[order]
        first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, np.int64)
        row = [shard, len(held), sum(x[1] for x in held), planes(np.array([x[0] for x in held], np.int64)), planes(np.array([x[1] for x in held])), planes(term[first]), planes(np.diff(np.r_[first, len(term)]), 4), planes(place, 4), planes(times, 4)]
        shard += 1
        held.clear()
        size = 0
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, [*[pa.int64()] * 3, *[pa.binary()] * 6], strict=True)], [c.split()[0] for c in _INDEX.split(", ")])

    for batch in batches:
        for bag in _bags(batch.column(0).to_pylist(), batch.column(1)):
            held.append(bag)
            size += len(bag[2])
            if size >= POSTINGS or len(held) >= DOCUMENTS:
                yield made()
    if held:
        yield made()
    trim()


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index table of ``docs``, written to the shared folder; rows with a null id are left out."""
    return written(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(_shards, _INDEX), "index")


def _dealt(buckets: int, numbers: int):
    """Rows (term, ...) of packed columns, dealt out by term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                term, n = unplanes(row[1]), unplanes(row[2], 4)
                cuts = np.searchsorted((term >> U(40)) * U(buckets) >> U(24), np.arange(buckets + 1, dtype=U))
                out = [(b, row[0], planes(term[cuts[b] : cuts[b + 1]]), planes(n[cuts[b] : cuts[b + 1]], numbers)) for b in range(buckets) if cuts[b] < cuts[b + 1]]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["bucket", "shard", "terms", "held"])

    return run


def _frequencies(index: pa.Table, asked: pa.Table) -> pa.Table:
    """Each asked (query, term, times) of a bucket with its document count over all shards."""
    terms = asked.column("term").to_numpy().view(U)
    u, back = np.unique(terms, return_inverse=True)
    total = np.zeros(len(u), np.int64)
    if len(u):
        for t, n in zip(index.column("terms").to_pylist(), index.column("held").to_pylist(), strict=True):
            t = unplanes(t)
            at = np.minimum(np.searchsorted(u, t), len(u) - 1)
            hit = u[at] == t
            total[at[hit]] += unplanes(n, 4)[hit].astype(np.int64)
    return pa.table([asked.column("query"), asked.column("term"), asked.column("times"), pa.array(total[back] if len(u) else total)], ["query", "term", "times", "held"])


@dataclass
class Asked:
    """Queries of a batch: their ids, each one's range of terms as places in ``terms``, in order, and the terms' weights."""

    ids: np.ndarray
    ranges: np.ndarray
    places: np.ndarray
    terms: np.ndarray
    weights: np.ndarray


def _batch(asked: pa.Table) -> Asked:
    query, term, weight = asked.column("query").to_numpy(), asked.column("term").to_numpy().view(U), asked.column("weight").to_numpy()
    order = np.lexsort((term, query))
    query, term, weight = query[order], term[order], weight[order]
    terms, first, back = np.unique(term, return_index=True, return_inverse=True)
    cuts = np.flatnonzero(np.r_[True, query[1:] != query[:-1], True]) if len(query) else np.zeros(1, np.int64)
    return Asked(query[cuts[:-1]], cuts, back.astype(np.int32), terms, weight[first])


def block_max_wand(lists: list[tuple[list[int], list[float], list[float], float]], k: int, floor: float = -1.0) -> list[tuple[float, int]]:
    """The best ``k`` (score, place) by falling score, then place; of those under ``floor`` any may be missing. lists: for each
    term the places in order, the score that each adds, the maximum of each block of postings, and of all."""
    best: list[tuple[float, int]] = []  # least first, of equal scores the later place first
    at = [0] * len(lists)
    live = [i for i in range(len(lists)) if lists[i][0]]
    full = floor * (1 - 1e-12) - 1e-9  # which is rounded
    while live:
        live.sort(key=lambda i: lists[i][0][at[i]])
        bound, pivot = 0.0, -1
        for n, i in enumerate(live):
            bound += lists[i][3]
            if bound > full:
                pivot = n
                break
        if pivot < 0:
            break
        d = lists[live[pivot]][0][at[live[pivot]]]
        while pivot + 1 < len(live) and lists[live[pivot + 1]][0][at[live[pivot + 1]]] == d:
            pivot += 1
        bound, upto = 0.0, lists[live[pivot + 1]][0][at[live[pivot + 1]]] if pivot + 1 < len(live) else 1 << 60
        for i in live[: pivot + 1]:
            places = lists[i][0]
            block = bisect_left(places, d, at[i]) // BLOCK
            if block * BLOCK < len(places):
                bound += lists[i][2][block]
                upto = min(upto, places[min(len(places), (block + 1) * BLOCK) - 1] + 1)
        if bound <= full:
            to = max(upto, d + 1)
        elif lists[live[0]][0][at[live[0]]] == d:
            score = round(sum(lists[i][1][at[i]] for i in live[: pivot + 1]), 9)
            if len(best) < k:
                heapq.heappush(best, (score, -d))
            elif (score, -d) > best[0]:
                heapq.heapreplace(best, (score, -d))
            if len(best) == k:
                full = max(full, best[0][0] * (1 - 1e-12))  # sums of bounds may round below a score
            to = d + 1
        else:
            to = d
        for i in live[: pivot + 1]:
            if lists[i][0][at[i]] < to:
                at[i] = bisect_left(lists[i][0], to, at[i])
        live = [i for i in live if at[i] < len(lists[i][0])]
    return [(s, -d) for s, d in sorted(best, reverse=True)]


def best_of_all(totals: np.ndarray, k: int, floor: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """The best ``k`` places by falling score, then place, and their scores, of all documents' scores; those of 0 or under ``floor`` are left out."""
    at = np.flatnonzero((totals > 0) & (totals >= floor))
    if len(at) > k:
        at = at[totals[at] >= np.partition(totals[at], len(at) - k)[len(at) - k]]
    at = at[np.argsort(-totals[at], kind="stable")][:k]
    return at, totals[at]


class Best:
    """The best ``k`` of each query so far: scores, falling, and ids; of equal scores the lesser id first."""

    def __init__(self, queries: int, k: int):
        self.scores, self.ids = np.full((queries, k), -1.0), np.zeros((queries, k), np.int64)

    def floor(self, q: int) -> float:
        return float(self.scores[q, -1])

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        s, i = np.r_[self.scores[q], scores], np.r_[self.ids[q], ids]
        order = np.lexsort((i, -s))[: self.scores.shape[1]]
        self.scores[q], self.ids[q] = s[order], i[order]


class Shard:
    """A shard's postings of the terms that a batch of queries asks for, with the score that each adds."""

    def __init__(self, row: dict, own: Asked, mean: float, k1: float, b: float):
        self.ids, lengths = unplanes(row["ids"]).view(np.int64), unplanes(row["lengths"]).astype(float)
        terms, held = unplanes(row["terms"]), unplanes(row["held"], 4).astype(np.int64)
        first = np.r_[0, np.cumsum(held)]
        n = np.minimum(np.searchsorted(terms, own.terms), len(terms) - 1)
        hit = np.flatnonzero(terms[n] == own.terms)
        n = n[hit]
        self.where = np.full(len(own.terms), -1, np.int64)  # of each asked term, its place among those that the shard has
        self.where[hit] = np.arange(len(hit))
        self.count = held[n]
        self.start = np.cumsum(self.count) - self.count
        every = _ranges(first[n], self.count)
        self.places = unplanes(row["places"], 4).astype(np.int32)[every]
        self.adds = unplanes(row["times"], 4).astype(np.float32)[every].astype(float)
        below = (k1 * (1 - b + b * lengths / mean))[self.places]
        below += self.adds
        self.adds *= k1 + 1
        self.adds /= below
        del every, below
        self.adds *= np.repeat(own.weights[hit], self.count)
        self.blocks: dict[int, tuple] = {}
        dense = np.flatnonzero(self.count * DENSE > len(self.ids))
        self.row = np.full(len(hit), -1, np.int64)  # of each term that many documents have, its row of the matrix
        self.row[dense] = np.arange(len(dense))
        self.matrix = np.zeros((len(dense), len(self.ids)))
        for r, t in enumerate(dense.tolist()):
            span = slice(self.start[t], self.start[t] + self.count[t])
            self.matrix[r, self.places[span]] = self.adds[span]

    def listed(self, t: int) -> tuple:
        if t not in self.blocks:
            span = slice(self.start[t], self.start[t] + self.count[t])
            adds = self.adds[span]
            self.blocks[t] = (self.places[span].tolist(), adds.tolist(), np.maximum.reduceat(adds, np.arange(0, len(adds), BLOCK)).tolist(), float(adds.max()))
        return self.blocks[t]

    def totals(self, queries: list[np.ndarray]) -> np.ndarray:
        """Scores of all documents (columns) for each query (its terms' places)."""
        size = np.array([len(q) for q in queries])
        query, term = np.repeat(np.arange(len(queries)), size), np.concatenate(queries)
        row = self.row[term]
        chosen = np.zeros((len(queries), len(self.matrix)))
        chosen[query[row >= 0], row[row >= 0]] = 1
        out = chosen @ self.matrix
        query, term = query[row < 0], term[row < 0]
        every = _ranges(self.start[term], self.count[term])
        cell = np.repeat(query * len(self.ids), self.count[term]) + self.places[every]
        return out + np.bincount(cell, self.adds[every], out.size).reshape(out.shape)


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    ends = np.cumsum(count)
    return np.repeat(start - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


def _found(asked, k: int, mean: float, k1: float, b: float):
    def taken(row: dict, own: Asked, best: Best) -> None:
        shard = Shard(row, own, mean, k1, b)
        held = shard.where[own.places]
        known = np.r_[0, np.cumsum(held >= 0)]
        cuts, held = known[own.ranges], held[held >= 0]
        step = max(1, CELLS // len(shard.ids))
        many = []
        for q, (x, y) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
            if 0 < y - x <= FEW:
                if got := block_max_wand([shard.listed(t) for t in held[x:y].tolist()], k, best.floor(q)):
                    best.add(q, np.array([s for s, _ in got]), shard.ids[[d for _, d in got]])
            elif y > x:
                many.append(q)
        for a in range(0, len(many), step):
            some = many[a : a + step]
            totals = np.round(shard.totals([held[cuts[q] : cuts[q + 1]] for q in some]), 9)
            for q, scores in zip(some, totals, strict=True):
                at, scores = best_of_all(scores, k, best.floor(q))
                if len(at):
                    best.add(q, scores, shard.ids[at])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        own, best = asked.value, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("ids", "lengths", "terms", "held", "places", "times")}
                if row["terms"]:
                    best = best or Best(len(own.ids), k)
                    taken(row, own, best)
                    trim()
        if best:
            q, n = np.nonzero(best.scores > 0)
            for a in range(0, len(q), 100_000):
                x, y = q[a : a + 100_000], n[a : a + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(own.ids[x]), pa.array(best.ids[x, y]), pa.array(best.scores[x, y])], ["query_id", "doc_id", "score"])
        trim()

    return run


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, _, term, times in _bags(batch.column(0).to_pylist(), batch.column(1)):
            if len(term):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(term), i, np.int64)), pa.array(term.view(np.int64)), pa.array(times.astype(np.int64))], ["query", "term", "times"])


def search(index: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 10, query_terms: int | None = None, k1: float = 1.2, b: float = 0.75, at_once: int = 2) -> DataFrame:
    """(query_id, rank, doc_id, score): the best ``k`` documents of each query, by falling score, then id.

    A document's score is the sum over the query's distinct terms of idf * tf (k1 + 1) / (tf + k1 (1 - b +
    b words / mean words)), idf = ln(1 + (N - n + 0.5) / (n + 0.5)). With ``query_terms`` a query is
    reduced to that many terms of its whole text, those that would add most to its own score (idf times
    (k1 + 1) / (times + k1); ties: by hash), as is usual for queries that are documents. Only documents with a term of the query are
    returned. Queries with a null id, no text or no indexed term return none; queries that share
    an id are one query of all their terms; documents that share an id are returned each.
    """
    spark = index.sparkSession
    documents, total = index.agg(F.sum("documents"), F.sum("words")).first()
    out = "query_id long, rank int, doc_id long, score double"
    if not documents or not total:
        return spark.createDataFrame([], out)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total * 6 / 3 / (24 << 20)))
    terms = index.select("shard", "terms", "held").mapInArrow(_dealt(buckets, 4), "bucket int, shard long, terms binary, held binary").repartition(buckets, "bucket").groupBy("bucket")
    asked = queries.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(_asked, "query long, term long, times long").groupBy("query", "term").agg(F.sum("times").alias("times"))
    bucket = F.shiftright(F.shiftrightunsigned("term", 40) * F.lit(buckets), 24).cast("int").alias("bucket")
    own = asked.select(bucket, "query", "term", "times").repartition(buckets, "bucket").groupBy("bucket")
    known = terms.cogroup(own).applyInArrow(_frequencies, "query long, term long, times long, held long").where("held > 0")
    weight = F.log(1 + (F.lit(float(documents)) - F.col("held") + 0.5) / (F.col("held") + 0.5))
    known = known.withColumn("weight", weight)
    if query_terms:
        gain = F.col("weight") * F.col("times") * (k1 + 1) / (F.col("times") + k1)
        order = Window.partitionBy("query").orderBy(F.desc(gain), "term")  # a document's own terms
        known = known.withColumn("n", F.row_number().over(order)).where(F.col("n") <= query_terms)
    chosen = written(known.select("query", "term", "weight"), "asked")
    parts = chosen.count() // ASKED + 1
    part = F.pmod(F.xxhash64("query"), F.lit(parts)).alias("part")
    if parts > 1:
        chosen = written(chosen.select("query", "term", "weight", part), "asked", by="part")

    def found(n: int) -> DataFrame:
        own = chosen.where(F.col("part") == n).drop("part") if parts > 1 else chosen
        asked = spark.sparkContext.broadcast(_batch(own.toArrow()))  # ASKED rows on average
        hits = written(index.coalesce(GROUPS).mapInArrow(_found(asked, k, total / documents, k1, b), "query_id long, doc_id long, score double"), "hits")
        asked.destroy()
        return hits

    with ThreadPoolExecutor(at_once) as pool:
        hits = reduce(DataFrame.union, pool.map(found, range(parts)))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")
