"""Passage deduplication by content-defined chunking.

A gear hash rolls over the bytes (a window of 16) and sets a chunk border at the first word start
after each place where it falls under a threshold, so borders depend on nearby content alone and
move with insertions. Chunks (four words on average) are compared by digest; the first in order of
document and place is the source of all later ones.

Later chunks in a row whose sources are in a row in one document are a run. A run of ``anchor`` words or more is
extended to both sides, word by word, against its source's text, and cut out if it then has ``min_words`` words or more. So a
cut passage is equal to an earlier one to its last word on either side (up to ``min_words - anchor`` beyond the run). A passage is missed
only if its chunks leave no run of ``anchor`` words: of 10 words, of 51, when the borders next to its ends are over 41 words
inside. Shared lines under ``min_words`` stay.

Skew: of a digest that repeats within a map batch only the first goes on, so a chunk that a third of
all rows share reaches its bucket once for each batch; the others have that first one as their source.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import mapped, quoted, unused, written
from .textops import BYTE, SPACE, U, flat, planes, prefix_hash, slices, span_hash, spans, trim, unplanes

GEAR = (BYTE >> U(32)).astype(np.uint32)
WINDOW = 16
#: Chunks that a map batch gathers before it sends them on.
FLUSH = 500_000
_PACKED = "bucket int, digest binary, id binary, place binary, words binary, source binary, at binary"
_REPEATS = "id long, place int, words int, digest long, source long, at int"


@dataclass
class Chunks:
    """Words and chunks of a slice of documents."""

    sums: np.ndarray  # of ``prefix_hash``
    starts: np.ndarray  # of each word, and its end
    ends: np.ndarray
    word_range: np.ndarray  # each document's words
    first: np.ndarray  # of each chunk, the first word; and the word after the last
    range: np.ndarray  # each document's chunks

    def digests(self, a: int = 0, b: int | None = None) -> np.ndarray:
        first = self.first[a : None if b is None else b + 1]
        if len(first) < 2:
            return np.zeros(0, U)
        return span_hash(self.sums, self.starts[first[:-1]], self.ends[first[1:] - 1])

    def words(self, a: int, b: int) -> np.ndarray:
        """Hashes of a range of words, of 32 bits."""
        return (span_hash(self.sums, self.starts[a:b], self.ends[a:b]) >> U(32)).astype(np.uint32)

    def around(self, doc: int, x: int, y: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of up to ``reach`` words before word x, backwards, and from word y on, within the document."""
        low, high = int(self.word_range[doc]), int(self.word_range[doc + 1])
        return self.words(max(low, x - reach), x)[::-1], self.words(y, min(high, y + reach))


def chunked(data: np.ndarray, at: np.ndarray, mean: int) -> Chunks:
    starts, ends, ranges = spans(~SPACE[data], at)
    if not len(starts):
        return Chunks(np.zeros(1, U), starts, ends, ranges, np.zeros(1, np.int64), ranges)
    h = GEAR[data]
    for s in (1, 2, 4, 8):
        own = h.copy()
        own[s:] += h[:-s] << np.uint32(s)
        h = own
    cut = np.flatnonzero(h < (1 << 32) // mean)
    cut = cut[cut - at[np.searchsorted(at, cut, "right") - 1] >= WINDOW - 1]  # the window lies within the document
    first = np.zeros(len(starts) + 1, bool)
    first[np.searchsorted(starts, cut + 1)] = True
    first[ranges[:-1]] = True
    chunk = np.flatnonzero(first[:-1])
    return Chunks(prefix_hash(data), starts, ends, ranges, np.r_[chunk, len(starts)], np.searchsorted(chunk, ranges))


def _chunks(mean: int, buckets: int):
    """(id, text) to packed chunks by digest, and to packed repeats (which have a source) within the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        digests, ids, places, words, held = [], [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal digests, ids, places, words, held
            if held:
                d, i, p, w = (np.concatenate(x) for x in (digests, ids, places, words))
                order = np.lexsort((p, i, d))
                d, i, p, w = d[order], i[order], p[order], w[order]
                new = np.r_[True, (d[1:] != d[:-1]) | (i[1:] != i[:-1]) | (p[1:] != p[:-1])]  # repeated rows
                d, i, p, w = d[new], i[new], p[new], w[new]
                head = np.r_[True, d[1:] != d[:-1]]
                rows = []
                if (~head).any():
                    of = np.flatnonzero(head)[np.cumsum(head) - 1]
                    later = ~head
                    rows.append((int(d[0]) % buckets, planes(d[later]), planes(i[later]), planes(p[later], 4), planes(w[later], 4), planes(i[of][later]), planes(p[of][later], 4)))
                d, i, p, w = d[head], i[head], p[head], w[head]
                cuts = np.searchsorted((d >> U(40)) * U(buckets) >> U(24), np.arange(buckets + 1, dtype=U))
                for b in range(buckets):
                    if cuts[b] < cuts[b + 1]:
                        own = slice(cuts[b], cuts[b + 1])
                        rows.append((b, planes(d[own]), planes(i[own]), planes(p[own], 4), planes(w[own], 4), None, None))
                kinds = (pa.int32(), *[pa.binary()] * 6)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], [c.split()[0] for c in _PACKED.split(", ")])
            digests, ids, places, words, held = [], [], [], [], 0

        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            doc = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            data, at = flat(batch.column(1))
            for i, j in slices(at):
                c = chunked(data[at[i] : at[j]], at[i : j + 1] - at[i], mean)
                count = np.diff(c.range)
                digest = c.digests()
                digests.append(digest)
                ids.append(np.repeat(doc[i:j], count))
                places.append(np.arange(len(digest)) - np.repeat(c.range[:-1], count))
                words.append(np.diff(c.first))
                held += len(digest)
                if held > FLUSH:
                    yield from flush()
        yield from flush()
        trim()

    return run


def _repeats(table: pa.Table) -> pa.Table:
    """All chunks of a bucket but the first of each digest, with that first one as their source."""
    columns = {c: table.column(c).to_pylist() for c in ("digest", "id", "place", "words", "source", "at")}
    width = {"digest": 8, "id": 8, "place": 4, "words": 4, "source": 8, "at": 4}

    def whole(name: str, rows: list[int]) -> np.ndarray:
        return np.concatenate([np.zeros(0, U), *(unplanes(columns[name][r], width[name]) for r in rows)])

    known = [k for k, x in enumerate(columns["source"]) if x is not None]
    out = {c: [whole(c, known)] for c in columns}
    rows = [k for k, x in enumerate(columns["source"]) if x is None]
    if rows:
        d, i, p, w = (whole(c, rows) for c in ("digest", "id", "place", "words"))
        order = np.lexsort((p, i.view(np.int64), d))
        d, i, p, w = d[order], i[order], p[order], w[order]
        first = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
        of = np.repeat(first, np.diff(np.r_[first, len(d)]))
        later = (i != i[of]) | (p != p[of])
        for c, x in zip(columns, (d, i, p, w, i[of], p[of]), strict=True):
            out[c].append(x[later])
    got = {c: np.concatenate(x) for c, x in out.items()}
    del out, columns
    trim()
    return pa.table([got["id"].view(np.int64), got["place"].astype(np.int32), got["words"].astype(np.int32), got["digest"].view(np.int64), got["source"].view(np.int64), got["at"].astype(np.int32)], [c.split()[0] for c in _REPEATS.split(", ")])


def _contexts(mean: int, reach: int):
    """(source, text, runs) to the words around each run of the source that is there as told."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = flat(batch.column(1))
            rows = []
            for i, j in slices(at):
                c = chunked(data[at[i] : at[j]], at[i : j + 1] - at[i], mean)
                for d in range(i, j):
                    own = c.digests(int(c.range[d - i]), int(c.range[d - i + 1]))
                    for r in batch.column(2)[d].as_py():
                        a, b = r["at"], r["at"] + r["n"] - 1
                        if b < len(own) and own[a] == U(r["head"] & _ALL) and own[b] == U(r["tail"] & _ALL):
                            x, y = (int(c.first[c.range[d - i] + k]) for k in (a, b + 1))
                            before, after = c.around(d - i, x, y, reach)
                            rows.append((batch.column(0)[d].as_py(), r["at"], r["n"], r["head"], r["tail"], before.tobytes(), after.tobytes()))
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["source", "at", "n", "head", "tail", "before", "after"])
        trim()

    return run


_ALL = (1 << 64) - 1


def _same(a: np.ndarray, b: np.ndarray) -> int:
    """How many numbers agree from the start."""
    n = min(len(a), len(b))
    apart = np.flatnonzero(a[:n] != b[:n])
    return int(apart[0]) if len(apart) else n


def _rebuilt(mean: int, min_words: int, text: int, found: int):
    """Batches with the column ``text`` less its repeats, and their spans and words added."""

    def passages(c: Chunks, doc: int, runs: list[dict]) -> list[tuple[int, int]]:
        """Ranges of words to cut, apart from each other and in order."""
        low, high = int(c.range[doc]), int(c.range[doc + 1])
        own = c.digests(low, high)
        out: list[list[int]] = []
        for r in sorted(runs, key=lambda r: r["place"]):
            a, b = r["place"], r["place"] + r["n"] - 1
            if b >= len(own) or own[a] != U(r["head"] & _ALL) or own[b] != U(r["tail"] & _ALL):
                continue  # of another row with this id
            x, y = int(c.first[low + a]), int(c.first[low + b + 1])
            before, after = np.frombuffer(r["before"], np.uint32), np.frombuffer(r["after"], np.uint32)
            left, right = c.around(doc, x, y, max(len(before), len(after)))
            x, y = x - _same(left, before), y + _same(right, after)
            if y - x >= min_words:
                out.append([x, y])
        joined: list[tuple[int, int]] = []
        for x, y in sorted(out):
            if joined and x <= joined[-1][1]:
                joined[-1] = (joined[-1][0], max(y, joined[-1][1]))
            else:
                joined.append((x, y))
        return joined

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column(text).cast(pa.string()), batch.column(found)
            out = texts.to_pylist()
            cuts: list[list[dict]] = [[] for _ in out]
            removed = np.zeros(len(out), np.int64)
            has = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False))
            if len(has):
                data, at = flat(texts.take(pa.array(has)))
                for i, j in slices(at):
                    part, own = data[at[i] : at[j]], at[i : j + 1] - at[i]
                    c = chunked(part, own, mean)
                    whole = part.tobytes()
                    for d in range(i, j):
                        row, high = int(has[d]), int(own[d - i + 1])
                        kept, done, chars = [], int(own[d - i]), 0
                        for x, y in passages(c, d - i, lists[row].as_py()):
                            s = int(c.starts[x])
                            e = int(c.starts[y]) if y < c.word_range[d - i + 1] else high
                            before = whole[done:s].decode("utf-8", "replace")
                            size = len(whole[s:e].decode("utf-8", "replace"))
                            cuts[row].append({"start": chars + len(before), "end": chars + len(before) + size})
                            chars += len(before) + size
                            kept.append(before)
                            removed[row] += y - x
                            done = e
                        if cuts[row]:
                            out[row] = "".join(kept) + whole[done:high].decode("utf-8", "replace")
            columns = list(batch.columns)
            columns[text] = pa.array(out, pa.string())
            del columns[found]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            names = [n for k, n in enumerate(batch.schema.names) if k != found]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(cuts, kind), pa.array(removed)], [*names, "cut", "removed_words"])
        trim()

    return run


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50, anchor: int = 10, mean: int = 24) -> DataFrame:
    """All rows and columns of ``docs``, the text without repeated passages; adds cut (spans in code points of the
    old text: array of start, end) and removed_words.

    A passage stays where it comes first, by id and then place, within a document as across them.
    Rows that share an id and text are the same occurrence, not repeats. Null and empty texts stay as
    they are; rows with a null id neither lose nor lend passages. Columns of ``docs`` named cut or
    removed_words are replaced; others may have any name.
    """
    spark = docs.sparkSession
    docs = docs.drop("cut", "removed_words")
    docs = docs.withColumn(text_col, F.col(quoted(text_col)).cast("string"))
    base = docs.select(F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(text_col)).alias("text"))
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(max(4, int(spark.conf.get("spark.sql.shuffle.partitions")), size * 14 / mean / (24 << 20)))
    packed = base.mapInArrow(_chunks(mean, buckets), _PACKED).repartition(buckets, "bucket")
    repeats = packed.groupBy("bucket").applyInArrow(_repeats, _REPEATS).withColumn("ahead", F.col("place") - F.col("at"))

    row = Window.partitionBy("id", "source", "ahead").orderBy("place")  # at most the chunks of a document
    runs = repeats.withColumn("island", F.col("place") - F.dense_rank().over(row)).groupBy("id", "source", "ahead", "island")
    runs = runs.agg(F.min("place").alias("place"), F.max("place").alias("last"), F.sum("words").alias("words"), F.min_by("digest", "place").alias("head"), F.max_by("digest", "place").alias("tail"))
    runs = written(runs.where(F.col("words") >= anchor).select("id", "place", (F.col("last") - F.col("place") + 1).alias("n"), "head", "tail", "source", (F.col("place") - F.col("ahead")).alias("at")), "runs")

    key = ["source", "at", "n", "head", "tail"]
    asked = runs.select(*key).distinct().groupBy("source").agg(F.collect_list(F.struct("at", "n", "head", "tail")).alias("runs"))  # of one document
    around = asked.join(base, F.col("source") == F.col("id")).select("source", "text", "runs").mapInArrow(_contexts(mean, max(min_words - anchor, 1)), "source long, at int, n int, head long, tail long, before binary, after binary")
    around = around.groupBy(*key).agg(F.max(F.struct("before", "after")).alias("words"))  # rows that share an id lend one
    whole = runs.join(around, key).select("id", F.struct("place", "n", "head", "tail", "words.before", "words.after").alias("run"))
    name, own = unused("runs", docs.columns), unused("run_of", docs.columns)
    lists = whole.groupBy(F.col("id").alias(own)).agg(F.collect_list("run").alias(name))  # of one document
    joined = docs.join(lists, F.col(quoted(id_col)).cast("long") == F.col(own), "left").drop(own)
    names = joined.columns
    spans_type = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    return mapped(joined, _rebuilt(mean, min_words, names.index(text_col), names.index(name)), [T.StructField("cut", spans_type), T.StructField("removed_words", T.LongType())], less=name)
