"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct k-word shingles. Each shingle is hashed to one bit of a
sketch and toggles it (XOR), so the Hamming distance of two sketches never exceeds the symmetric
difference D of the sets. ``inter/union >= num/den`` means
``D <= (|a| + |b|) * (den - num) / (den + num)``.

Sizes fall into bands by powers of 1.4; a pair meets in the band of its larger set, so a document
is entered in its own band and in higher ones that a partner may reach. Within a band a sketch has
m blocks of 2**32 bits (kept sparse). D differing bits touch at most D blocks; hence, with blocks in any
order that depends on their content alone, two partners agree on a block that is among the first
D + 1 of both (pigeonhole). The order used is by falling number of set bits, then by position, so
that the keys are the most telling blocks and empty ones are not met. No pair is lost.

Documents that agree on a block are not compared with each other at once. Within a map batch, and then among
the heads of all batches, the least of them is the key's pivot and only the pairs of the pivot with each other one are kept,
each distinct pair once; those whose sketches allow a link are verified on the sets, and connected components are taken of the links. What is left
to compare are documents of different components below the same pivot (its others, and theirs within a batch), as all that
share a key are below that key's pivot. The documents below pivots that have such are entered by their keys once more, so that only
true holders of a key meet below its pivot, each a number of times that its own keys bound, and not all documents below a batch's head below all
pivots of that head. Below each pivot of a key with different components, pairs of different
components are found by Hamming distance of 1024-bit sketches, and the documents of such pairs are verified. A pivot with over ``block`` shingles below it
is dealt into blocks, and every two blocks meet in a task. No closure is taken over unverified agreement, so chance agreements do not add up to large groups.

Skew: exact copies are joined within a map batch, and only one head of each key goes on, so a key held by a third
of all rows arrives as one entry for each batch. Sets are shipped for documents of some pair only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import connected_components
from .scratch import quoted, settled, unused, written
from .textops import U, mix, planes, shingle_sets, trim, unplanes

_PACKED = "bucket int, kind int, a binary, b binary"
_EDGES = "kind int, a long, b long"
#: Kinds of pairs: a key and its holder; a pivot and another of its batch; a pivot and another batch's head; exact copies; a document and its set's size.
KEY, LOCAL, GLOBAL, SAME, SIZE = 0, 1, 2, 3, 4
#: Keys that a map batch gathers before it sends them on.
FLUSH = 500_000
#: Ids of documents of some pair up to which they are sent to the texts; beyond, the texts are shuffled to them.
SENT = 1_000_000
#: Set bits of a sketch by which two documents of a group are compared first.
WORDS = 16


class Bands:
    """The size bands of a threshold ``num/den``."""

    def __init__(self, num: int, den: int, growth: float = 1.4):
        if not 0 < num <= den:
            raise ValueError("the threshold must be over 0 and at most 1")
        self.num, self.den = num, den
        self.low = [1]
        while self.low[-1] < 1 << 40:
            self.low.append(max(self.low[-1] + 1, int(self.low[-1] * growth)))

    def most(self, a: int, b: int) -> int:
        """The largest symmetric difference of two linked sets of these sizes."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether two sets of sorted hashes reach the threshold."""
        if min(len(a), len(b)) * self.den < max(len(a), len(b)) * self.num:
            return False
        both = len(np.intersect1d(a, b, assume_unique=True))
        return bool(len(a)) and self.den * both >= self.num * (len(a) + len(b) - both)

    def of(self, n: int) -> Iterator[tuple[int, int, int]]:
        """(band, blocks of its sketches, keys) for each band that a set of ``n`` shingles is entered in."""
        j = int(np.searchsorted(self.low, n, "right")) - 1
        while n * self.den >= self.low[j] * self.num:
            top = self.low[j + 1] - 1
            d = self.most(n, min(top, n * self.den // self.num))
            if d:  # else only equal sets are linked
                yield j, 3 * (self.most(top, top) + 1) // 2, d + 1
            j += 1

    def keys(self, s: np.ndarray) -> np.ndarray:
        """The keys of a set of sorted hashes, over all its bands."""
        out = [np.zeros(0, U)]
        bit = mix(s & U(0xFFFFFFFF)) if len(s) else s
        for band, m, count in self.of(len(s)):
            block = ((s >> U(32)) * U(m)) >> U(32)  # rises with s
            first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            word = np.bitwise_xor.reduceat(bit, first)
            held = np.diff(np.r_[first, len(s)])
            block = block[first]
            if len(first) > count:
                order = np.argsort(-held, kind="stable")[:count]
                word, block = word[order], block[order]
            elif len(first) < count:  # then empty blocks, lowest first, complete the list
                empty = np.setdiff1d(np.arange(min(m, count), dtype=U), block, assume_unique=True)[: count - len(first)]
                word, block = np.r_[word, np.zeros(len(empty), U)], np.r_[block, empty]
            out.append(mix(word ^ mix(block + U(band << 40))))
        return np.concatenate(out)


def _sketched(k: int, bands: Bands, buckets: int):
    """Map batches of (doc_id, text) to packed keys and the edges found within the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        keys, nodes, held = [], [], 0
        seen: dict[tuple[int, int], int] = {}
        edges: dict[int, list[tuple[int, int]]] = {SAME: [], SIZE: []}

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal keys, nodes, held
            rows: list[tuple[int, int, bytes, bytes]] = []
            if keys:
                key, node = np.concatenate(keys), np.repeat(np.array([n for n, _ in nodes], np.int64), [c for _, c in nodes])
                order = np.lexsort((node, key))
                key, node = key[order], node[order]
                head = np.r_[True, key[1:] != key[:-1]]
                lead = node[head][np.cumsum(head) - 1]
                near = ~head & (lead != node)
                if near.any():
                    pairs = np.unique(np.stack([lead[near], node[near]], 1), axis=0)
                    rows.append((int(pairs[0, 0]) % buckets, LOCAL, planes(pairs[:, 0]), planes(pairs[:, 1])))
                key, node = key[head], node[head]
                to = (key >> U(48)).astype(np.int64) * buckets >> 16
                cuts = np.searchsorted(to, np.arange(buckets + 1))
                for b in range(buckets):
                    if cuts[b] < cuts[b + 1]:
                        rows.append((b, KEY, planes(key[cuts[b] : cuts[b + 1]]), planes(node[cuts[b] : cuts[b + 1]])))
            for kind, found in edges.items():
                if found:
                    e = np.array(found, np.int64)
                    rows.append((int(e[0, 0]) % buckets, kind, planes(e[:, 0]), planes(e[:, 1])))
                    found.clear()
            keys, nodes, held = [], [], 0
            seen.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["bucket", "kind", "a", "b"])

        for batch in batches:
            for i, s in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), k), strict=True):
                if i is None:
                    continue
                edges[SIZE].append((i, len(s)))
                if not len(s):
                    continue
                sign = (int(np.bitwise_xor.reduce(s)), int(np.add.reduce(mix(s)))) if len(s) > 1 else (int(s[0]), len(s))
                first = seen.setdefault(sign, i)
                if first != i:
                    edges[SAME].append((first, i))
                    continue
                own = bands.keys(s)
                if not len(own):  # too small for a difference: found by its digest
                    own = np.array([sign[0] ^ 0x5BD1E995], U)
                keys.append(own)
                nodes.append((i, len(own)))
                held += len(own)
                if held > FLUSH:
                    yield from flush()
        yield from flush()
        trim()

    return run


def _met(buckets: int):
    """The keys of a bucket to pairs of pivot and head, dealt anew by pair; pairs found before pass through."""

    def run(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        a, b = table.column("a").to_pylist(), table.column("b").to_pylist()

        def whole(which: int) -> tuple[np.ndarray, np.ndarray]:
            rows = np.flatnonzero(kind == which).tolist()
            return tuple(np.concatenate([np.zeros(0, U), *(unplanes(c[r]) for r in rows)]) for c in (a, b))

        found = {which: whole(which) for which in (LOCAL, SAME, SIZE)}
        key, node = whole(KEY)
        node = node.view(np.int64)
        order = np.argsort(key, kind="stable")
        key, node = key[order], node[order]
        head = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
        least = np.minimum.reduceat(node, np.flatnonzero(head))[np.cumsum(head) - 1] if len(key) else node
        other = node != least
        found[GLOBAL] = least[other].view(U), node[other].view(U)
        rows = []
        for which, (x, y) in found.items():
            to = (mix(x ^ mix(y)) >> U(32)) * U(buckets) >> U(32)
            order = np.lexsort((y, x, to))
            x, y, to = x[order], y[order], to[order]
            new = np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])] if len(x) else np.zeros(0, bool)
            x, y, to = x[new], y[new], to[new]
            cuts = np.searchsorted(to, np.arange(buckets + 1, dtype=U))
            rows += [(i, which, planes(x[cuts[i] : cuts[i + 1]]), planes(y[cuts[i] : cuts[i + 1]])) for i in np.flatnonzero(np.diff(cuts)).tolist()]
        out = pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["bucket", "kind", "a", "b"])
        del found, key, node, order, head, least, other, a, b, rows
        trim()
        return out

    return run


def _paired(table: pa.Table) -> pa.Table:
    """The distinct pairs of a bucket; a pair of both kinds is LOCAL and GLOBAL."""
    kind = table.column("kind").to_numpy()
    a, b = table.column("a").to_pylist(), table.column("b").to_pylist()
    out: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for which in np.unique(kind).tolist():
        rows = np.flatnonzero(kind == which).tolist()
        pairs = np.unique(np.stack([np.concatenate([unplanes(c[r]) for r in rows]).view(np.int64) for c in (a, b)], 1), axis=0)
        out.append((np.full(len(pairs), which, np.int32), pairs[:, 0], pairs[:, 1]))
    return pa.table([np.concatenate(c) for c in zip(*out, strict=True)], ["kind", "a", "b"])


def parity(s: np.ndarray) -> np.ndarray:
    """The set's parity sketch of 64 * WORDS bits."""
    odd = np.bincount((s >> U(20)).astype(np.int64) % (64 * WORDS), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(U)


def links(nodes: np.ndarray, sets: list[np.ndarray], bands: Bands, labels: np.ndarray | None = None, side: np.ndarray | None = None) -> np.ndarray:
    """Verified links that join the same documents as all links among ``sets`` do: rows (node, node).

    Documents of equal ``labels`` are joined already. With ``side`` (0 or 1 for each set) the links within a side are left to other calls.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    size = np.array([len(sets[o]) for o in order], np.int64)
    sketch = np.stack([parity(sets[o]) for o in order])
    root = np.unique(labels[order], return_inverse=True)[1] if labels is not None else np.arange(len(order))
    place = side[order] if side is not None else None
    found = []
    for x in range(len(order) - 1):
        end = int(np.searchsorted(size, size[x] * bands.den // bands.num, "right"))
        left = root[x + 1 : end] != root[x]
        if place is not None:
            left &= place[x + 1 : end] != place[x]
        left = np.flatnonzero(left) + x + 1
        if not len(left):
            continue
        apart = np.bitwise_count(sketch[left] ^ sketch[x]).sum(1, dtype=np.int64)
        own = sets[order[x]]
        for y in left[apart <= bands.most(size[left], size[x])].tolist():
            if root[y] != root[x] and bands.linked(own, sets[order[y]]):
                found.append((nodes[order[x]], nodes[order[y]]))
                root[root == root[y]] = root[x]
    return np.array(found, np.int64).reshape(-1, 2)


def _solved(bands: Bands):
    def run(table: pa.Table) -> pa.Table:
        nodes, labels = table.column("node").to_numpy(), table.column("root").to_numpy()
        sets = [np.frombuffer(s, U) for s in table.column("hashes").to_pylist()]
        one, two = table.column("one")[0].as_py(), table.column("two")[0].as_py()
        side = None if one == two else (table.column("own").to_numpy() == two).astype(np.int8)
        e = links(nodes, sets, bands, labels, side)
        return pa.table([e[:, 0], e[:, 1]], ["a", "b"])

    return run


def _close(bands: Bands):
    """Batches of (a, b, n and sketch of a, of b) to the pairs (a, b) whose sketches allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(k).to_numpy() for k in (2, 4))
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), U).reshape(-1, WORDS) for k in (3, 5))
            apart = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
            hit = (apart <= bands.most(n, m)) & (np.minimum(n, m) * bands.den >= np.maximum(n, m) * bands.num)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(hit))
        trim()

    return run


def _met_below(bands: Bands):
    """The documents of a block, or of two, that have one of another component whose sketch allows a link."""

    def run(table: pa.Table) -> pa.Table:
        one, two = table.column("one")[0].as_py(), table.column("two")[0].as_py()
        size = table.column("n").to_numpy()
        order = np.argsort(size, kind="stable")
        size, root, own = size[order], table.column("root").to_numpy()[order], table.column("own").to_numpy()[order]
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), U).reshape(-1, WORDS)[order]
        wanted = np.zeros(len(order), bool)
        for x in range(len(order) - 1):
            end = int(np.searchsorted(size, size[x] * bands.den // bands.num, "right"))
            left = root[x + 1 : end] != root[x]
            if one != two:
                left &= own[x + 1 : end] != own[x]
            left = np.flatnonzero(left) + x + 1
            if len(left):
                hit = left[np.bitwise_count(sketch[left] ^ sketch[x]).sum(1, dtype=np.int64) <= bands.most(size[left], size[x])]
                wanted[hit] = True
                wanted[x] |= len(hit) > 0
        return table.select(["pivot", "one", "two", "own", "node", "root", "n"]).take(pa.array(order[wanted]))

    return run


def _verified(bands: Bands):
    """Batches of (a, b, set of a, set of b) to the pairs that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = [bands.linked(np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(hit, pa.bool_()))
        trim()

    return run


def _hashed(k: int):
    """Batches of (node, text) to (node, n, sketch, hashes): its set's size, parity sketch and, as bytes, hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column(1), k))
            columns = [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), *(pa.array([x.tobytes() for x in xs], pa.binary()) for xs in (map(parity, sets), sets))]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "sketch", "hashes"])
        trim()

    return run


def _unsettled(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, root) of all documents below pivots that have documents of different components not yet compared."""
    own = lambda name: roots.select(F.col("node").alias(name), F.col("root").alias(f"{name}_root"))
    known = pairs.join(own("b"), "b", "left").withColumn("b_root", F.coalesce("b_root", "b"))
    known = written(known.select("kind", "a", "b", "b_root"), "pairs")
    local, heads = known.where(F.col("kind") == LOCAL), known.where(F.col("kind") == GLOBAL)
    spread = [F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"), F.sum("deep").alias("deep")]
    below = local.groupBy("a").agg(F.min("b_root").alias("low"), F.max("b_root").alias("high"), F.count("*").alias("n"), F.lit(0).cast("long").alias("deep"))
    under = heads.join(below.select(F.col("a").alias("b"), "low", "high", "n"), "b", "left")
    under = under.select("a", F.least("b_root", "low").alias("low"), F.greatest("b_root", "high").alias("high"), (F.coalesce("n", F.lit(0)) + 1).alias("n"), F.coalesce("n", F.lit(0)).alias("deep"))
    pivots = below.unionByName(under).groupBy("a").agg(*spread).where("n > 1").join(own("a"), "a", "left").withColumn("a_root", F.coalesce("a_root", "a"))
    # the pivot itself has met all but those two steps below
    pivots = written(pivots.where("low <> high or (deep > 0 and (a_root <> low or a_root <> high))").select("a", "a_root"), "pivots")
    direct = known.join(pivots.select("a"), "a", "left_semi")
    leads = direct.where(F.col("kind") == GLOBAL).select(F.col("b").alias("a")).distinct()
    found = direct.unionByName(local.join(leads, "a", "left_semi")).select(F.col("b").alias("node"), F.col("b_root").alias("root"))
    return found.unionByName(pivots.select(F.col("a").alias("node"), F.col("a_root").alias("root"))).distinct()


def _keyed(bands: Bands, buckets: int):
    """Map batches of (node, root, hashes) to packed keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes, roots, held = [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal keys, nodes, roots, held
            if held:
                count = [len(x) for x in keys]
                key, node, root = np.concatenate(keys), np.repeat(np.array(nodes, np.int64), count), np.repeat(np.array(roots, np.int64), count)
                order = np.argsort(key, kind="stable")
                key, node, root = key[order], node[order], root[order]
                cuts = np.searchsorted((key >> U(48)).astype(np.int64) * buckets >> 16, np.arange(buckets + 1))
                full = np.flatnonzero(np.diff(cuts)).tolist()
                columns = [pa.array([planes(x[cuts[i] : cuts[i + 1]]) for i in full], pa.binary()) for x in (key, node, root)]
                yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *columns], ["bucket", "key", "node", "root"])
            keys, nodes, roots, held = [], [], [], 0

        for batch in batches:
            for node, root, s in zip(*(batch.column(k).to_pylist() for k in (0, 1)), batch.column(2), strict=True):
                keys.append(bands.keys(np.frombuffer(s.as_buffer(), U)))
                nodes.append(node)
                roots.append(root)
                held += len(keys[-1])
                if held > FLUSH:
                    yield from flush()
        yield from flush()
        trim()

    return run


def _met_again(buckets: int):
    """The keys of a bucket that documents of different components hold, to (pivot, node, root), their least holder and each holder, dealt anew by pair."""

    def run(table: pa.Table) -> pa.Table:
        key, node, root = _columns(table, "key", "node", "root")
        node, root = node.view(np.int64), root.view(np.int64)
        order = np.argsort(key, kind="stable")
        key, node, root = key[order], node[order], root[order]
        head = np.r_[True, key[1:] != key[:-1]]
        first, of = np.flatnonzero(head), np.cumsum(head) - 1
        wanted = (np.minimum.reduceat(root, first) != np.maximum.reduceat(root, first))[of]
        least = np.minimum.reduceat(node, first)[of]
        found = np.unique(np.stack([least[wanted], node[wanted], root[wanted]], 1), axis=0).view(U)
        to = (mix(found[:, 0] ^ mix(found[:, 1])) >> U(32)) * U(buckets) >> U(32)
        order = np.argsort(to, kind="stable")
        found, cuts = found[order], np.searchsorted(to[order], np.arange(buckets + 1, dtype=U))
        full = np.flatnonzero(np.diff(cuts)).tolist()
        columns = [pa.array([planes(found[cuts[i] : cuts[i + 1], c]) for i in full], pa.binary()) for c in range(3)]
        del key, node, root, order, head, first, of, wanted, least, found, to
        trim()
        return pa.table([pa.array(full, pa.int32()), *columns], ["bucket", "pivot", "node", "root"])

    return run


def _unpacked(table: pa.Table) -> pa.Table:
    """The distinct (pivot, node, root) of a bucket."""
    rows = np.unique(np.stack([c.view(np.int64) for c in _columns(table, "pivot", "node", "root")], 1), axis=0)
    return pa.table([rows[:, 0], rows[:, 1], rows[:, 2]], ["pivot", "node", "root"])


def _columns(table: pa.Table, *names: str) -> list[np.ndarray]:
    """Columns of byte planes as numbers, all rows in one."""
    return [np.concatenate([unplanes(x) for x in table.column(c).to_pylist()]) for c in names]


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 80, den: int = 100, block: int = 400_000) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each document id, by links ``den * inter >= num * union``.

    component_id is the smallest id that links reach, the document's own included. A null or
    wordless text has no shingles and no links. Rows with a null id are left out. Rows that share
    an id count as one document: it has the links of each, and the largest n_shingles.
    Extra columns are ignored; an empty table gives an empty one. ``block`` is the number of
    shingles in memory of a task, twice at most (a longer single document has more); it changes no result.
    """
    bands = Bands(num, den)
    docs = docs.select(F.col(quoted(id_col)).cast("long").alias("node"), F.col(quoted(text_col)).cast("string").alias("text")).where("node is not null")
    return settled(lambda: _components(docs, k, bands, block), "near").withColumnRenamed("node", id_col)


def _components(docs: DataFrame, k: int, bands: Bands, block: int) -> DataFrame:
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    share = 0.35 * 9 * (bands.den - bands.num) / (bands.den + bands.num)  # bytes of packed keys for each byte of text, about
    buckets = int(max(4, int(spark.conf.get("spark.sql.shuffle.partitions")), size * share / (24 << 20)))
    packed = docs.mapInArrow(_sketched(k, bands, buckets), _PACKED).repartition(buckets, "bucket")
    met = packed.groupBy("bucket").applyInArrow(_met(buckets), _PACKED).repartition(buckets, "bucket")
    edges = written(met.groupBy("bucket").applyInArrow(_paired, _EDGES), "pairs")
    sizes = edges.where(F.col("kind") == SIZE).groupBy(F.col("a").alias("node")).agg(F.max("b").alias("n_shingles"))
    exact = edges.where(F.col("kind") == SAME).select("a", "b")
    pairs = edges.where(F.col("kind").isin(LOCAL, GLOBAL) & (F.col("a") != F.col("b")))

    members = written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "members")
    members = F.broadcast(members) if members.count() <= SENT else members  # ids
    sets = written(docs.join(members, "node", "left_semi").mapInArrow(_hashed(k), "node long, n long, sketch binary, hashes binary"), "sets")

    def beside(found: DataFrame, *columns: str) -> DataFrame:
        """(a, b, ...) with ``columns`` of the sets of both."""
        for c in "ab":
            found = found.join(sets.select(F.col("node").alias(c), *(F.col(x).alias(f"{x}_{c}") for x in columns)), c)
        return found.select("a", "b", *(f"{x}_{c}" for c in "ab" for x in columns))

    close = beside(pairs.select("a", "b").distinct(), "n", "sketch").mapInArrow(_close(bands), "a long, b long").distinct()
    linked = written(beside(close, "hashes").mapInArrow(_verified(bands), "a long, b long"), "links")
    roots = connected_components(linked.unionByName(exact), "components")

    again = written(_unsettled(pairs, roots), "again")
    again = F.broadcast(again) if again.count() <= SENT else again  # ids
    keyed = sets.join(again, "node").select("node", "root", "hashes").mapInArrow(_keyed(bands, buckets), "bucket int, key binary, node binary, root binary").repartition(buckets, "bucket")
    dealt = keyed.groupBy("bucket").applyInArrow(_met_again(buckets), "bucket int, pivot binary, node binary, root binary").repartition(buckets, "bucket")
    below = dealt.groupBy("bucket").applyInArrow(_unpacked, "pivot long, node long, root long")
    below = written(below.join(sets.select("node", "n").distinct(), "node"), "below")
    parts = F.ceil(F.col("total") / F.lit(block)).cast("int")
    totals = below.groupBy("pivot").agg(F.sum("n").alias("total"))
    dealt = below.join(totals, "pivot").withColumn("own", F.pmod(F.xxhash64("node"), parts).cast("int"))
    meets = F.when(parts <= 1, F.array(F.struct(F.lit(0).alias("one"), F.lit(0).alias("two")))).otherwise(
        F.transform(F.sequence(F.lit(0), parts - 1), lambda i: F.struct(F.least(i, F.col("own")).alias("one"), F.greatest(i, F.col("own")).alias("two")))
    )
    dealt = dealt.select("pivot", "own", "node", "root", "n", F.explode(meets).alias("meet")).select("pivot", "meet.one", "meet.two", "own", "node", "root", "n")
    found = dealt.join(sets.select("node", "n", "sketch"), ["node", "n"]).groupBy("pivot", "one", "two")
    close = written(found.applyInArrow(_met_below(bands), "pivot long, one int, two int, own int, node long, root long, n long"), "close")
    groups = close.join(sets.select("node", "n", "hashes"), ["node", "n"]).groupBy("pivot", "one", "two")
    later = written(groups.applyInArrow(_solved(bands), "a long, b long"), "links")
    if not later.isEmpty():
        roots = connected_components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(later), "components")
    root = roots.withColumnRenamed("root", "component")
    return sizes.join(root, "node", "left").select("node", F.col("n_shingles").cast(T.LongType()), F.coalesce("component", "node").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows and columns of ``docs`` less those that have a smaller id in their group of near-duplicates.

    Rows with a null id stay, as nothing is known of their copies; so do all rows of a kept id.
    """
    found = near_components(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), **options)
    gone = unused("gone", docs.columns)
    others = found.where("component_id <> doc_id").select(F.col("doc_id").alias(gone))
    return docs.join(others, F.col(quoted(id_col)).cast("long") == F.col(gone), "left_anti")
