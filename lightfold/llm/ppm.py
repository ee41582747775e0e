"""Language-model scores by prediction by partial matching, over bytes.

Texts are reduced to their words: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, each followed by a
space, and an end byte. A trie holds how often each byte followed each context of up to ``ORDER``
bytes in the training texts. A byte seen in its longest known context has probability
c / (n + q) there (n: bytes seen, q: distinct ones; the escape has q / (n + q)); otherwise the model
escapes to the context one byte shorter, leaving out the bytes that the longer one offered (symbol
exclusion), and at last to all bytes not offered yet.

Since all that followed a context also followed its endings, what is left out at an order is known
from the next longer context alone, so the trie is flattened to sorted arrays and whole batches are
looked up at once, each distinct (context, byte) once.

Counts cover all training texts. A trie of up to ``NODES`` leaves is sent to executors whole. If there are
more, the grams stay in a table in parts that share the context's last ``LOW`` + 1 bytes: all contexts of
that length or more are in a gram's part, and the shorter ones' counts, at most 256 ** (LOW + 1) of them, go to every part. The
scores of the most frequent grams, up to ``NODES``, are then sent, and all others joined, so that
the model is the same.

Words are counted likewise. The ``COMMON`` most frequent words are looked up in a broadcast table, all
others by a join on the word's hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import written
from .textops import LOWER, SPACE, U, flat, prefix_hash, slices, span_hash, spans, trim
from .toxicity import remainder

ORDER = 5
NODES = 4_000_000
LOW = 1
COMMON = 1_000_000
#: Grams of a part of the table, on average.
PART = 500_000
#: Distinct entries that a map task gathers before it sends them on.
FLUSH = 1_000_000
END_WORD = 0x7E5D_0000_0000_0E0D


def canonical(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each document as ORDER zero bytes, its lower-cased words with a space after each, and a zero byte; the
    borders; each word's start and end; and each document's range of words."""
    data = LOWER[data]
    starts, ends, ranges = spans(~SPACE[data], at)
    size = ends - starts + 1
    own = np.repeat(np.arange(len(at) - 1), np.diff(ranges))
    total = np.bincount(own, size, len(at) - 1).astype(np.int64) + ORDER + 1
    border = np.r_[0, np.cumsum(total)]
    out = np.zeros(border[-1], np.uint8)
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    kept = data[np.cumsum(inside[:-1]) > 0]
    first = np.cumsum(size) - size
    to = first + (own + 1) * ORDER + own  # where each word goes: after earlier documents' padding and end bytes
    place = np.repeat(to - (np.cumsum(ends - starts) - (ends - starts)), ends - starts) + np.arange(len(kept))
    out[place] = kept
    out[to + size - 1] = 0x20
    return out, border, to, to + size - 1, ranges


def grams(data: np.ndarray, border: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ORDER + 1 bytes that end at each byte, as a number, padding bytes left out; and the borders."""
    x = data.astype(U)
    n = len(x) - ORDER
    g = np.zeros(max(n, 0), U)
    for k in range(ORDER + 1):
        g = g << U(8) | x[k : k + n]
    keep = np.ones(len(data), bool)
    for k in range(ORDER):
        keep[border[:-1] + k] = False
    return g[keep[ORDER:]], border - ORDER * np.arange(len(border))


@dataclass
class Trie:
    """For each order: (context, byte) in order and count; contexts in order with n, q and the next shorter order's
    count of the bytes they offer."""

    entries: list[np.ndarray]
    counts: list[np.ndarray]
    contexts: list[np.ndarray]
    seen: list[np.ndarray]
    kinds: list[np.ndarray]
    offered: list[np.ndarray]

    def log10(self, g: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of each number after the bytes before it."""
        out = np.zeros(len(g))
        open_ = np.arange(len(g))  # not yet predicted
        began = np.zeros(len(g), bool)
        left_n, left_q = np.zeros(len(g), np.int64), np.zeros(len(g), np.int64)  # offered by the longer context
        for k in range(ORDER, -1, -1):
            key = g[open_] & U((1 << 8 * (k + 1)) - 1)
            at, hit = _find(self.entries[k], key)
            node, known = _find(self.contexts[k], key >> U(8))
            n = self.seen[k][node] - left_n[open_] if len(self.contexts[k]) else np.zeros(len(open_), np.int64)
            q = self.kinds[k][node] - left_q[open_] if len(self.contexts[k]) else np.zeros(len(open_), np.int64)
            use = known & (n > 0)
            c = self.counts[k][at] if len(self.entries[k]) else np.zeros(len(open_), np.int64)
            hit &= use
            out[open_[hit]] += np.log10(c[hit] / (n + q)[hit])
            miss = use & ~hit
            out[open_[miss]] += np.log10(q[miss] / (n + q)[miss])
            here = open_[known]
            began[here] = True
            if k:
                left_n[here], left_q[here] = self.offered[k][node[known]], self.kinds[k][node[known]]
            else:
                left_q[here] = self.kinds[0][node[known]]
            open_ = open_[~hit]
        out[open_] -= np.log10(256 - np.minimum(left_q[open_], 255))
        return out


def _find(table: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
    at = np.minimum(np.searchsorted(table, key), len(table) - 1)
    return at, table[at] == key


def trie(gram: np.ndarray, count: np.ndarray, low: tuple[np.ndarray, np.ndarray] | None = None) -> Trie:
    """The trie of all orders from the counts of its longest entries; low: the entries of order ``LOW`` and their counts,
    where ``gram`` is a part of the table."""
    order = np.argsort(gram)
    levels = [(gram[order], count[order].astype(np.int64))]
    for k in range(ORDER - 1, -1, -1):
        if k == LOW and low is not None:
            levels.insert(0, low)
            continue
        key = levels[0][0] & U((1 << 8 * (k + 1)) - 1)
        u, back = np.unique(key, return_inverse=True)
        levels.insert(0, (u, np.bincount(back, levels[0][1], len(u)).astype(np.int64)))
    out = Trie([], [], [], [], [], [])
    for k, (entry, c) in enumerate(levels):
        context, first = np.unique(entry >> U(8), return_index=True)
        out.entries.append(entry)
        out.counts.append(c)
        out.contexts.append(context)
        out.seen.append(np.add.reduceat(c, first) if len(first) else c[:0])
        out.kinds.append(np.diff(np.r_[first, len(entry)]))
        if k and len(first):
            shorter, c0 = levels[k - 1]
            out.offered.append(np.add.reduceat(c0[np.searchsorted(shorter, entry & U((1 << 8 * k) - 1))], first))
        else:
            out.offered.append(np.zeros(len(first), np.int64))
    return out


def _prepared(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of documents: (first, after, word hashes, their borders, grams, their borders)."""
    data, at = flat(texts)
    for i, j in slices(at):
        part, own = data[at[i] : at[j]], at[i : j + 1] - at[i]
        text, border, starts, ends, ranges = canonical(part, own)
        words = span_hash(prefix_hash(text), starts, ends)
        g, edges = grams(text, border)
        yield i, j, words, ranges, g, edges


def _merged(a: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, n = np.unique(keys, return_counts=True)
    k = np.concatenate([a[0], u])
    order = np.argsort(k, kind="stable")
    k, c = k[order], np.concatenate([a[1], n])[order]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(c, first) if len(first) else c


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training texts to (kind, key, n): 0 for words, 1 for grams, 2 for documents."""
    none = (np.zeros(0, U), np.zeros(0, np.int64))
    held = [none, none]
    docs = 0

    def rows(kind: int, table: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(table[0]), 200_000):
            k, n = table[0][a : a + 200_000], table[1][a : a + 200_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k.view(np.int64)), pa.array(n)], ["kind", "key", "n"])

    for batch in batches:
        docs += batch.num_rows
        for _, _, words, _, g, _ in _prepared(batch.column(0)):
            for kind, keys in ((0, words), (1, g)):
                held[kind] = _merged(held[kind], keys)
                if len(held[kind][0]) > FLUSH:
                    yield from rows(kind, held[kind])
                    held[kind] = none
    for kind in (0, 1):
        yield from rows(kind, held[kind])
    yield from rows(2, (np.zeros(1, U), np.array([docs])))
    trim()


class Left:
    """Keys that documents of a batch left to look up: for each document, distinct ones and how often."""

    def __init__(self, n: int):
        self.keys, self.times, self.size = [np.zeros(0, U)], [np.zeros(0, np.int64)], np.zeros(n, np.int64)

    def add(self, own: np.ndarray, keys: np.ndarray) -> None:
        order = np.lexsort((keys, own))
        own, keys = own[order], keys[order]
        first = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (keys[1:] != keys[:-1])]) if len(keys) else np.zeros(0, np.int64)
        self.keys.append(keys[first])
        self.times.append(np.diff(np.r_[first, len(keys)]))
        self.size += np.bincount(own[first], minlength=len(self.size))

    def lists(self) -> pa.ListArray:
        offsets = pa.array(np.r_[0, np.cumsum(self.size)].astype(np.int32))
        return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(np.concatenate(self.keys).view(np.int64)), pa.array(np.concatenate(self.times))], ["key", "times"]))


def _scored(model, common):
    """(doc_id, held_out, text) to the score of grams that ``model`` (a trie, or grams and their scores) has, the common
    words' part of the base, and the words and grams left to look up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = model.value
        known, count = common.value
        for batch in batches:
            n = batch.num_rows
            score, part = np.zeros(n), np.zeros(n)
            tokens, hits = np.zeros(n, np.int64), np.zeros(n, np.int64)
            rare, left = Left(n), Left(n)
            for i, j, words, ranges, g, edges in _prepared(batch.column(2)):
                u, back = np.unique(g, return_inverse=True)
                if isinstance(tree, Trie):
                    logs = tree.log10(u)
                else:
                    at, hit = _find(tree[0], u)
                    logs = np.where(hit, tree[1][at] if len(tree[1]) else 0, 0)
                    left.add(np.repeat(np.arange(i, j), np.diff(edges))[~hit[back]], g[~hit[back]])
                sums = np.r_[0, np.cumsum(logs[back])]
                score[i:j] = sums[edges[1:]] - sums[edges[:-1]]
                tokens[i:j] = np.diff(ranges)
                at, hit = _find(known, words)
                c = np.where(hit, count[at] if len(count) else 0, 0)
                sums = np.r_[0, np.cumsum(np.where(hit, np.log10(c + 1.0), 0))]
                part[i:j] = sums[ranges[1:]] - sums[ranges[:-1]]
                sums = np.r_[0, np.cumsum(hit)]
                hits[i:j] = sums[ranges[1:]] - sums[ranges[:-1]]
                rare.add(np.repeat(np.arange(i, j), np.diff(ranges))[~hit], words[~hit])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tokens), pa.array(hits), pa.array(part), pa.array(score), rare.lists(), left.lists()], ["doc_id", "held_out", "words", "hits", "part", "score", "rare", "left"])
        trim()

    return run


def _logs(low):
    """log10 probability of each asked gram, from the grams of its part."""

    def run(grams_: pa.Table, asked: pa.Table) -> pa.Table:
        key, n, g = (c.to_numpy() for c in (grams_.column("key"), grams_.column("n"), asked.column("key")))
        return pa.table([pa.array(g), pa.array(trie(key.view(U), n, low.value).log10(g.view(U)))], ["key", "log"])

    return run


def _floor(table: DataFrame, most: int) -> int:
    """The least count by which at most ``most`` rows of ``table`` (n) are kept, of steps of a tenth."""
    step = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(1.1)))).cast("int")
    rows = table.groupBy(step.alias("step")).agg(F.count("*"), F.min("n")).collect()  # a few hundred rows
    kept, least = 0, 1 << 62
    for _, size, low in sorted(rows, reverse=True):
        if kept + size > most:
            break
        kept, least = kept + size, low
    return least


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", holdout: tuple[int, int] = (7, 2)) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row.

    Training texts are those whose crc32 remainder of the id (a null id: of the empty text) is not held
    out. A null or empty text is its end alone. base_score sums log10((c + 1) / (N + V + 1)) over words
    and end; score is the log10 probability of the text, reduced to words, under the trie. Repeated
    rows count and score each; extra columns are ignored; an empty table gives an empty one. Without
    training texts every byte is as likely as any.
    """
    spark = docs.sparkSession
    held_out = (remainder(id_col, holdout[0]) == holdout[1]).alias("held_out")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out, F.col(text_col).cast("string").alias("text"))
    counted = docs.where("not held_out").select("text").mapInArrow(_counted, "kind int, key long, n long")
    table = written(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    sums = {k: (v, s) for k, v, s in table.groupBy("kind").agg(F.count("*"), F.sum("n")).collect()}
    documents = sums.get(2, (0, 0))[1]
    total = sums.get(0, (0, 0))[1] + documents
    distinct = sums.get(0, (0, 0))[0] + bool(documents)

    def kept(kind: int, most: int) -> tuple[np.ndarray, np.ndarray, bool]:
        """At most ``most`` of the most frequent rows, in order of key."""
        own = table.where(F.col("kind") == kind)
        least = _floor(own, most)
        got = own.where(F.col("n") >= least).select("key", "n").toArrow()
        key, n = got.column(0).to_numpy().view(U), got.column(1).to_numpy()
        order = np.argsort(key)
        return key[order], n[order], least > 1

    def looked_up(keys: DataFrame) -> DataFrame:
        """(key, log) of grams, each once."""
        part = F.pmod(F.xxhash64(F.shiftright("key", 8).bitwiseAND((1 << 8 * LOW + 8) - 1)), F.lit(parts)).alias("part")
        of = lambda df, *c: df.select(part, *c).repartition(parts, "part").groupBy("part")
        return of(own, "key", "n").cogroup(of(keys, "key")).applyInArrow(_logs(low), "key long, log double")

    words_, n_words, more = kept(0, COMMON)
    common = spark.sparkContext.broadcast((words_, n_words))  # bounded by COMMON, the model by NODES
    whole = sums.get(1, (0, 0))[0] <= NODES
    if whole:
        model = spark.sparkContext.broadcast(trie(*kept(1, NODES)[:2]))
    else:
        own = table.where("kind = 1")
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(sums[1][0] / PART))
        short = own.groupBy(F.col("key").bitwiseAND((1 << 8 * (LOW + 1)) - 1).alias("key")).agg(F.sum("n").alias("n")).orderBy("key").toArrow()
        low = spark.sparkContext.broadcast((short.column(0).to_numpy().view(U), short.column(1).to_numpy()))
        got = looked_up(own.where(F.col("n") >= _floor(own, NODES))).toArrow()
        key, log = got.column(0).to_numpy().view(U), got.column(1).to_numpy()
        order = np.argsort(key)
        model = spark.sparkContext.broadcast((key[order], log[order]))
    scored = docs.mapInArrow(_scored(model, common), "doc_id long, held_out boolean, words long, hits long, part double, score double, rare array<struct<key:long,times:long>>, left array<struct<key:long,times:long>>")
    scored = written(scored.withColumn("row", F.monotonically_increasing_id()), "scores")
    base = scored.select("row", "doc_id", "held_out", "words", "hits", "part", "score")
    rest = scored.select("row", F.explode("rare").alias("r")).select("row", "r.key", "r.times")
    counts = table.where("kind = 0").select("key", "n")
    if more:
        counts = counts.where(F.col("n") < int(n_words.min()) if len(n_words) else F.lit(True))
        found = rest.join(counts, "key").groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more"), F.sum("times").alias("known"))
        base = base.join(found, "row", "left")
    else:  # every training word was in the broadcast table
        base = base.withColumns({"more": F.lit(0.0), "known": F.lit(0).cast("long")})
    if not whole:
        rest = scored.select("row", F.explode("left").alias("r")).select("row", "r.key", "r.times")
        found = rest.join(looked_up(rest.select("key").distinct()), "key").groupBy("row").agg(F.sum(F.col("times") * F.col("log")).alias("other"))
        base = base.join(found, "row", "left").withColumn("score", F.col("score") + F.coalesce("other", F.lit(0.0)))
    end = bool(documents)
    tokens = F.col("words") + 1
    return base.select(
        "doc_id", "held_out", tokens.alias("n_tokens"), (F.col("hits") + F.coalesce("known", F.lit(0)) + F.lit(int(end))).cast("long").alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("part") + F.coalesce("more", F.lit(0.0)) + F.lit(float(np.log10(documents + 1))) - tokens * F.lit(float(np.log10(total + distinct + 1)))).alias("base_score"), "score",
    )
