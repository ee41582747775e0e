"""Best-fit packing by length patterns.

Lengths are known exactly, but only their histogram (at most ``size`` numbers, whatever the number
of documents) is needed to plan. Patterns of up to four length classes that fill a sequence are
enumerated; repeat counts are fitted to the histogram by non-negative least squares and rounded
down; each pattern takes exact lengths, its last place the longest length that still fits; what is
left is packed best-fit decreasing. All of it works on counts, many sequences at a time, so a plan
has a bounded number of lines. Pieces then find their places by their rank among equal lengths.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .pretokens import Memory, byte_level
from .scratch import written
from .textops import CACHES, flat, slices, trim

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


class Encoder:
    """Token ids of whole texts by a byte-level BPE tokenizer file, each distinct pre-token encoded once."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memory = Memory(self._make)

    def _make(self, spans: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast([s.decode("utf-8", "replace") for s in spans], add_special_tokens=False)]
        return np.fromiter((i for x in ids for i in x), np.int32), np.array([len(x) for x in ids], np.int64)

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, in order; a null text has none."""
        data, at = flat(texts)
        for i, j in slices(at):
            part, own = data[at[i] : at[j]], at[i : j + 1] - at[i]
            whole = part.tobytes()
            starts, ranges = byte_level(part, own)
            if len(starts):
                ids, ends = self.memory.ragged(self.memory.of(part, starts, np.r_[starts[1:], len(part)]))
                cuts = np.r_[0, ends][ranges]
            special = any(s in whole for s in self.special)
            for d in range(j - i):
                text = whole[own[d] : own[d + 1]] if special else b""
                if special and any(s in text for s in self.special):  # the library cuts these out before it splits
                    yield np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, np.int32)
                else:
                    yield ids[cuts[d] : cuts[d + 1]] if len(starts) else np.zeros(0, np.int32)


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


CACHES["ids"] = encoder.cache_clear


def _cut(path: str, size: int, end: int):
    """(doc_id, text) to pieces, each with its rank among its task's pieces of equal length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim("ids")
        part, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in batches:
            rows = []
            for i, ids in zip(batch.column(0).to_pylist(), encoder(path).encode(batch.column(1)), strict=True):
                whole = np.append(ids, np.int32(end)).astype("<u4")
                n = len(whole)
                first = n if n <= size else n % size
                cuts = [0, *range(first or size, n, size), n]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append((i, k, a, b - a, zlib.crc32(whole[a:b].tobytes()), part, int(seen[b - a])))
                    seen[b - a] += 1
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
        trim("ids")

    return run


def patterns(units: int, most: int = 4) -> np.ndarray:
    """All ways to fill ``units`` by 2 to ``most`` classes: rows of falling class numbers, padded with 0."""
    found = []

    def extend(head: list[int], rest: int) -> None:
        if len(head) >= 1 and rest <= head[-1]:
            found.append([*head, rest] + [0] * (most - len(head) - 1))
        if len(head) < most - 1:
            low = -(-rest // (most - len(head)))
            for c in range(min(head[-1] if head else units - 1, rest - 1), low - 1, -1):
                extend([*head, c], rest - c)

    extend([], units)
    return np.unique(np.array([f for f in found if f[1]]), axis=0)


def nnls(columns: np.ndarray, target: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Least squares without negative weights (Lawson and Hanson's active sets); columns: class numbers of each pattern."""
    n = len(target)
    a = np.zeros((n, len(columns)))
    for k in range(columns.shape[1]):
        held = columns[:, k] > 0
        np.add.at(a, (columns[held, k] - 1, np.flatnonzero(held)), 1.0)
    x, active = np.zeros(len(columns)), np.zeros(len(columns), bool)
    floor = 1e-9 * max(1.0, float(np.abs(a.T @ target).max(initial=0)))
    for _ in range(rounds):
        slope = np.where(active, -np.inf, a.T @ (target - a @ x))
        j = int(np.argmax(slope))
        if slope[j] <= floor or active.sum() >= n:
            break
        active[j] = True
        while True:
            own = np.flatnonzero(active)
            z = np.linalg.lstsq(a[:, own], target, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[own] = z
                break
            low = own[z <= 0]
            step = np.min(x[low] / np.maximum(x[low] - z[z <= 0], 1e-300))
            x[own] += step * (z - x[own])
            gone = own[x[own] <= 1e-12]
            x[gone] = 0
            active[gone if len(gone) else low] = False
            if not active.any():
                break
    return x


def plan(histogram: np.ndarray, classes: int = 128) -> list[tuple[list[int], int]]:
    """Sequences for ``histogram`` (count by length, place 0 unused): (lengths in order, repeats) that use each piece once."""
    size = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    out: list[tuple[list[int], int]] = []
    if left[size]:
        out.append(([size], int(left[size])))
        left[size] = 0
    width = -(-size // classes)
    units = size // width
    grouped = np.array([left[1 + width * c : 1 + width * (c + 1)].sum() for c in range(units)], float)

    def longest(top: int) -> int:
        """The longest length left up to ``top``, or 0."""
        here = np.flatnonzero(left[1 : top + 1])
        return int(here[-1]) + 1 if len(here) else 0

    def within(c: int, need: dict[int, int]) -> int:
        for n in range(min(size, width * c), width * (c - 1), -1):
            if left[n] > need.get(n, 0):
                return n
        return 0

    def take(lengths: list[int], most: int | None) -> int:
        kinds, each = np.unique(lengths, return_counts=True)
        times = int((left[kinds] // each).min())
        times = times if most is None else min(times, most)
        left[kinds] -= each * times
        if times:
            out.append((lengths, times))
        return times

    shapes = patterns(units)
    fitted = np.floor(nnls(shapes, grouped) + 1e-9).astype(np.int64) if grouped.sum() else np.zeros(len(shapes), np.int64)
    for shape, repeats in sorted(zip(shapes.tolist(), fitted.tolist(), strict=True), reverse=True):
        places = [c for c in shape if c]
        while repeats > 0:
            lengths: list[int] = []
            need: dict[int, int] = {}
            for c in places[:-1]:
                if not (n := within(c, need)):
                    break
                lengths.append(n)
                need[n] = need.get(n, 0) + 1
            else:
                gap = size - sum(lengths)
                while gap > 0 and (n := longest(gap)):
                    if left[n] <= need.get(n, 0):
                        held = left[n]
                        left[n] = 0
                        m = longest(gap)
                        left[n] = held
                        n = m
                    if not n or left[n] <= need.get(n, 0):
                        break
                    lengths.append(n)
                    need[n] = need.get(n, 0) + 1
                    gap -= n
                done = take(lengths, repeats)
                repeats -= done
                if done:
                    continue
            break
    while first := longest(size):  # best fit, decreasing, for the rest
        lengths, gap = [first], size - first
        left[first] -= 1
        while gap > 0 and (n := longest(gap)):
            lengths.append(n)
            left[n] -= 1
            gap -= n
        np.add.at(left, lengths, 1)
        take(lengths, None)
    return out


def lines(found: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """The plan by place: (length, first rank, rank after the last, sequence of the first, offset)."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, times in found:
        offset = 0
        for n in lengths:
            low = used.get(n, 0)
            rows.append((n, low, low + times, sequence, offset))
            used[n] = low + times
            offset += n
        sequence += times
    return rows


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = 2048, end: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for each piece of each row.

    A document is its ids and ``end``; a null or empty text is ``end`` alone. A longer one than
    ``size`` is cut into pieces of ``size`` after a first piece of what is over. Each row is a
    document, so repeated rows and null ids are packed like others; which of several equal
    lengths goes where is not fixed. Extra columns are ignored; an empty table gives an empty one.

    The texts are read once and never shuffled. A piece's rank among equal lengths is its rank in
    its task plus the counts of earlier tasks, so a length that a third of all rows share is not
    gathered anywhere. The plan has at most a few lines for each length, and is broadcast.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cut = written(docs.mapInArrow(_cut(path, size, end), _PIECES), "pieces")
    counts = cut.groupBy("part", "length").agg((F.max("nth") + 1).alias("n"))
    before = counts.select("part", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).alias("before"))
    histogram = np.zeros(size + 1, np.int64)
    for n, c in counts.groupBy("length").agg(F.sum("n")).collect():  # at most ``size`` rows
        histogram[n] = c
    rows = lines(plan(histogram))
    places = spark.createDataFrame(rows or [(0, 0, 0, 0, 0)], "length long, low long, high long, sequence long, offset long")
    by_length = places.groupBy("length").agg(F.array_sort(F.collect_list(F.struct("low", "high", "sequence", "offset"))).alias("places"))
    ranked = cut.join(before, ["part", "length"]).withColumn("rank", F.col("nth") + F.coalesce("before", F.lit(0)))
    # bounded: a few lines for each of ``size`` lengths
    found = ranked.join(F.broadcast(by_length), "length").withColumn("place", F.filter("places", lambda p: (p.low <= F.col("rank")) & (p.high > F.col("rank")))[0])
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("place.sequence") + F.col("rank") - F.col("place.low")).alias("sequence_id"), F.col("place.offset").alias("offset"))
