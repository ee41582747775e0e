"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its distinct words (runs of letters, lower-cased) and the words' first four
and five bytes, hashed to 2**26 numbers. The score is a logistic factorization machine over the
terms present: bias + sum of weights + sum over pairs of terms of the product of their factors, so
that terms which are harmless alone can add up together, and the reverse.

Fitting uses a bounded, documented sample of the labelled rows and happens on the driver; scoring
reads each whole text once, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import mapped
from .textops import LOWER, U, flat, mix, prefix_hash, slices, span_hash, spans, trim

LETTERS = np.zeros(256, bool)
LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True
BITS = 26


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed terms of each text, and the border after each text; a null text has none."""
    data, at = flat(texts)
    out, count = [], []
    for i, j in slices(at):
        part, own = LOWER[data[at[i] : at[j]]], at[i : j + 1] - at[i]
        if len(part) > 1:  # capitals of Latin-1 are two bytes
            second = (part[:-1] == 0xC3) & (part[1:] >= 0x80) & (part[1:] < 0x9F) & (part[1:] != 0x97)
            part[1:][second] += 0x20
        starts, ends, ranges = spans(LETTERS[part], own)
        sums = prefix_hash(part)
        every = np.stack([(span_hash(sums, starts, np.minimum(ends, starts + n)) + U(t)) for t, n in ((0, 1 << 30), (1, 4), (2, 5))], 1)
        every = mix(every) >> U(64 - BITS)
        for a, b in zip(ranges[:-1].tolist(), ranges[1:].tolist(), strict=True):
            own_terms = np.unique(every[a:b])
            out.append(own_terms)
            count.append(len(own_terms))
    return (np.concatenate(out).astype(np.uint32) if out else np.zeros(0, np.uint32)), np.cumsum(count, dtype=np.int64)


@dataclass
class Machine:
    """A fitted machine: its terms in order, their weights and factors."""

    bias: float
    known: np.ndarray
    weight: np.ndarray
    factor: np.ndarray

    def scores(self, flat_terms: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The score of each text, 0 to 1."""
        own = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        if len(self.known) and len(flat_terms):
            place = np.minimum(np.searchsorted(self.known, flat_terms), len(self.known) - 1)
            hit = self.known[place] == flat_terms
            own, place = own[hit], place[hit]
        else:
            own = place = np.zeros(0, np.int64)
        return 1 / (1 + np.exp(-np.clip(_raw(self.bias, self.weight, self.factor, place, own, len(ends))[0], -60, 60)))


def _raw(bias: float, weight: np.ndarray, factor: np.ndarray, place: np.ndarray, own: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    linear = np.bincount(own, weight[place], n)
    k = factor.shape[1]
    v = factor[place]
    sums = np.stack([np.bincount(own, v[:, f], n) for f in range(k)], 1) if len(place) else np.zeros((n, k))
    squares = np.bincount(own, (v * v).sum(1), n) if len(place) else np.zeros(n)
    return bias + linear + 0.5 * ((sums * sums).sum(1) - squares), sums


def _likelihood(one: np.ndarray, total: np.ndarray, ones: float, n: int) -> np.ndarray:
    """Twice the log likelihood ratio of the label given presence; ``one`` of ``total`` texts that have it are among the ``ones`` of ``n``."""

    def part(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(a > 0, a * np.log(np.maximum(a, 1e-12) / np.maximum(b, 1e-12)), 0)

    p = ones / n
    rest, rest_one = n - total, ones - one
    return 2 * (part(one, total * p) + part(total - one, total * (1 - p)) + part(rest_one, rest * p) + part(rest - rest_one, rest * (1 - p)))


def _paired(known: np.ndarray, total: np.ndarray, one: np.ndarray, flat_terms: np.ndarray, ends: np.ndarray, y: np.ndarray, telling: float, most: int) -> np.ndarray:
    """Of the ``most`` most frequent terms in under two thirds of the texts, those that tell the label together with another of
    them, by ``telling`` more than either does alone and more than the two added up."""
    n, ones = len(y), float(y.sum())
    some = np.flatnonzero(total < n * 2 / 3)
    some = np.sort(some[np.argsort(-total[some], kind="stable")[:most]])
    if not len(some):
        return np.zeros(0, np.int64)
    own = known[some]
    both, both_one = np.zeros((2, len(some), len(some)))
    border = np.r_[0, ends]
    for a in range(0, n, 2000):
        b = min(a + 2000, n)
        terms_ = flat_terms[border[a] : border[b]]
        place = np.minimum(np.searchsorted(own, terms_), len(own) - 1)
        hit = np.flatnonzero(own[place] == terms_)
        have = np.zeros((b - a, len(some)), np.float32)
        have[np.searchsorted(ends, hit + border[a], "right") - a, place[hit]] = 1
        both += have.T @ have
        both_one += have.T @ (have * y[a:b, None].astype(np.float32))
    alone = _likelihood(one[some], total[some], ones, n)
    # what the two would give if they did not interact: odds multiplied
    odds = lambda a, b: (a + 0.5) / (b - a + 0.5)
    base = odds(ones, n)
    mine = odds(one[some], total[some])
    expected = mine[:, None] * mine / base
    expected = both * expected / (1 + expected)
    apart = np.where(both_one > 0, both_one * np.log(np.maximum(both_one, 1e-12) / np.maximum(expected, 1e-12)), 0)
    rest, rest_expected = both - both_one, both - expected
    apart = 2 * (apart + np.where(rest > 0, rest * np.log(np.maximum(rest, 1e-12) / np.maximum(rest_expected, 1e-12)), 0))
    together = _likelihood(both_one, both, ones, n) - np.maximum(alone[:, None], alone)
    found = (both >= 8) & (together >= telling) & (apart >= telling)
    np.fill_diagonal(found, False)
    return some[found.any(1)]


def fit(flat_terms: np.ndarray, ends: np.ndarray, labels: np.ndarray, factors: int = 8, steps: int = 2500, rate: float = 0.15, decay: float = 1e-5, least: int = 4, telling: float = 15.0, together: float = 45.0, frequent: int = 1000, seed: int = 7) -> Machine:
    """Fit by AdaGrad over mini-batches of 256, ``steps`` at least. Terms in under ``least`` texts are left out, and so are those that
    tell little of the label: neither by presence alone (likelihood ratio of ``telling``) nor, among the ``frequent`` most frequent ones, by presence
    together with another (``together``, higher as there are many pairs). So a term that is neutral alone stays if a pair needs it. Without both labels the score is the share of 1."""
    n, y = len(labels), labels.astype(np.float64)
    share = (y.sum() + 0.5) / (n + 1)
    bias = float(np.log(share / (1 - share)))
    empty = Machine(bias, np.zeros(0, np.uint32), np.zeros(0), np.zeros((0, factors)))
    if not n or y.min() == y.max() or not len(flat_terms):
        return empty
    own_of = np.repeat(y > 0, np.diff(ends, prepend=0))
    known, total = np.unique(flat_terms, return_counts=True)
    marked, times = np.unique(flat_terms[own_of], return_counts=True)
    del own_of
    one = np.zeros(len(known))
    one[np.searchsorted(known, marked)] = times

    common = total >= least
    known, total, one = known[common], total[common].astype(float), one[common]
    kept = _likelihood(one, total, y.sum(), n) >= telling
    kept[_paired(known, total, one, flat_terms, ends, y, together, frequent)] = True
    known = known[kept]
    if not len(known):
        return empty
    hits, places = [], []
    for at in range(0, len(flat_terms), 1 << 20):
        some = flat_terms[at : at + (1 << 20)]
        place = np.minimum(np.searchsorted(known, some), len(known) - 1)
        hit = np.flatnonzero(known[place] == some)
        hits.append(hit + at)
        places.append(place[hit])
    place = np.concatenate(places)
    own = np.searchsorted(ends, np.concatenate(hits), "right")
    border = np.searchsorted(own, np.arange(n + 1))
    rng = np.random.default_rng(seed)
    w, v = np.zeros(len(known)), rng.normal(0, 0.02, (len(known), factors))
    gw, gv, gb = np.full(len(known), 1e-6), np.full(v.shape, 1e-6), 1e-6
    size = min(256, n)
    for _ in range(-(-steps // -(-n // size))):
        order = rng.permutation(n)
        for at in range(0, n, size):
            rows = order[at : at + size]
            held = border[rows + 1] - border[rows]
            ends_ = np.cumsum(held)
            x = place[np.repeat(border[rows] - (ends_ - held), held) + np.arange(ends_[-1])]
            o = np.repeat(np.arange(len(rows)), held)
            raw, sums = _raw(bias, w, v, x, o, len(rows))
            err = (1 / (1 + np.exp(-np.clip(raw, -60, 60))) - y[rows]) / len(rows)
            step = err.sum()
            gb += step * step
            bias -= rate * step / np.sqrt(gb)
            u, back = np.unique(x, return_inverse=True)
            g = np.bincount(back, err[o], len(u)) + decay * w[u]
            gw[u] += g * g
            w[u] -= rate * g / np.sqrt(gw[u])
            each = err[o, None] * (sums[o] - v[x])
            g = np.stack([np.bincount(back, each[:, f], len(u)) for f in range(factors)], 1) + decay * v[u]
            gv[u] += g * g
            v[u] -= 0.3 * rate * g / np.sqrt(gv[u])
    return Machine(bias, known, w, v)


def remainder(id_col: str, parts: int):
    """crc32 of the id as text, modulo ``parts``; a null id counts as its empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = 16_000, holdout: tuple[int, int] = (3, 1), **options) -> Machine:
    """A machine from at most ``sample`` labelled rows (those of the least id hashes) whose crc32 remainder is not held out.

    Rows of ``labels`` that disagree on an id, have a null or another label than 0 and 1 are left out, and so are labels without a document. Of rows of ``docs``
    that share an id, the text of the least hash counts, so there are at most ``sample`` texts; repeated rows of ``labels`` count once.
    """
    parts, held = holdout
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).where("_id is not null and _label in (0, 1)")
    known = known.groupBy("_id").agg(F.min("_label").alias("_label"), F.max("_label").alias("_top")).where("_label = _top").where(remainder("_id", parts) != held)
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(sample).select("_id", "_label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        for b in batches:
            t, ends = terms(b.column(2))
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(t.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], ["key", "label", "terms"])

    own = docs.select(F.col(id_col).alias("_own"), F.col(text_col).cast("string").alias("_text"))
    # bounded: ``sample`` pairs of numbers
    rows = own.join(F.broadcast(chosen), F.col("_own") == F.col("_id")).groupBy("_id").agg(F.min_by(F.struct("_label", "_text"), F.xxhash64("_text")).alias("r")).select(F.xxhash64("_id").alias("key"), "r.*")
    got = rows.mapInArrow(run, "key long, label int, terms array<int>").toArrow().sort_by("key").combine_chunks()  # so that reruns agree
    lists = got.column("terms").combine_chunks()
    flat_terms = lists.flatten().to_numpy().view(np.uint32)
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64) if len(lists) else np.zeros(0, np.int64)
    return fit(flat_terms, ends, got.column("label").to_numpy().astype(np.int64), **options)


def score(docs: DataFrame, machine: Machine, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """All rows and columns of ``docs`` with score (double) and predicted (int), which replace columns of these names.

    Null and empty texts get the score of no terms. Other columns may have any name; repeated rows have a row each.
    """
    held = docs.sparkSession.sparkContext.broadcast(machine)  # bounded by the sample
    docs = docs.drop("score", "predicted")
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        for b in batches:
            s = held.value.scores(*terms(b.column(at)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))], [*b.schema.names, "score", "predicted"])
        trim()

    return mapped(docs, run, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
