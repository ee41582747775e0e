"""Token counts by rank-synchronous merging of ragged arrays.

The distinct pre-tokens of a batch lie in one flat array of symbols. In each round every
pre-token takes its pair of lowest rank (leftmost among equals), all at the same time, until none
has a pair that is a piece; the symbols that survive are counted. This is the vocabulary's own
BPE, so counts equal the library's.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pretokens import Memory, code_points, pieces
from .textops import CACHES, SLICE, flat, slices, trim

_NONE = np.int64(1) << 62
#: Pre-tokens of more characters are merged by a heap, in n log n.
LONG = 256


class Merges:
    """The pairs of a sentencepiece BPE model, and what becomes of them."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        kinds = (model.is_unknown, model.is_control, model.is_byte, model.is_unused)
        piece = {model.id_to_piece(i): i for i in range(size) if not any(k(i) for k in kinds)}
        if any("▁" in p.lstrip("▁") or "\n" in p for p in piece):
            raise ValueError("the vocabulary has pieces across words")
        self.size = size
        self.char = np.full(0x110000, -1, np.int32)
        for p, i in piece.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        self.char[0x20] = self.char[0x2581]
        score = {i: model.get_score(i) for i in piece.values()}
        rank = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        found = {}
        for p, i in piece.items():
            for cut in range(1, len(p)):
                a, b = piece.get(p[:cut]), piece.get(p[cut:])
                if a is not None and b is not None:
                    found[a * size + b] = (rank[score[i]], i)
        self.pair = np.array(sorted(found), np.int64)
        self.rank = np.array([found[k][0] for k in self.pair.tolist()], np.int64)
        self.to = np.array([found[k][1] for k in self.pair.tolist()], np.int32)
        self.found = found

    def look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (or ``_NONE``) and its place in the table."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where((self.pair[at] == key) & (left >= 0) & (right >= 0), self.rank[at], _NONE), at

    def count(self, spans: list[bytes]) -> np.ndarray:
        """Surviving symbols of each span of UTF-8; a character outside the vocabulary counts its bytes."""
        out = np.zeros(len(spans), np.int64)
        data = np.frombuffer(b"".join(spans), np.uint8)
        ends = np.cumsum([len(s) for s in spans])
        lead, cp = code_points(data)
        width = np.diff(np.r_[lead, len(data)])
        own = np.searchsorted(ends, lead, "right")
        sym = self.char[cp]
        strange = sym < 0
        np.add.at(out, own[strange], width[strange] - 1)
        length = np.bincount(own, minlength=len(spans))
        for i in np.flatnonzero(length > LONG).tolist():
            out[i] += self._heap(sym[own == i].tolist())
        keep = length[own] <= LONG
        sym, own = sym[keep], own[keep]
        while len(sym):
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            rank = np.full(len(sym), _NONE)
            at = np.zeros(len(sym), np.int64)
            rank[:-1], at[:-1] = self.look(sym[:-1], sym[1:])
            rank[np.r_[first[1:], len(sym)] - 1] = _NONE
            best = np.minimum.reduceat(np.where(rank < _NONE, rank << 32 | np.arange(len(sym)), _NONE), first)
            count = np.diff(np.r_[first, len(sym)])
            done = best == _NONE
            out[own[first[done]]] += count[done]
            place = best[~done] & 0xFFFFFFFF
            sym[place] = self.to[at[place]]
            alive = np.repeat(~done, count)
            alive[place + 1] = False
            sym, own = sym[alive], own[alive]
        return out

    def _heap(self, sym: list[int]) -> int:
        """The same merges of one long sequence."""
        n = len(sym)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = right[i]
            if j >= 0 and sym[i] >= 0 and sym[j] >= 0 and (hit := self.found.get(sym[i] * self.size + sym[j])):
                heapq.heappush(heap, (hit[0], i, sym[i], sym[j], hit[1]))

        for i in range(n):
            offer(i)
        gone = -2
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = right[i]
            if sym[i] != a or j < 0 or sym[j] != b:
                continue
            sym[i], sym[j] = new, gone
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            n -= 1
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return n


@lru_cache(maxsize=2)
def _memory(path: str) -> Memory:
    merges = Merges(path)

    def make(spans: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        counts = merges.count(spans)
        return counts, np.ones(len(counts), np.int64)

    return Memory(make)


CACHES["counts"] = _memory.cache_clear


def count_tokens(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and tokens of each text; a null text is empty and has none."""
    memory = _memory(path)
    data, at = flat(texts)
    out = np.zeros(len(texts), np.int64)
    for i, j in slices(at, SLICE):
        part, own = data[at[i] : at[j]], at[i : j + 1] - at[i]
        if len(part) and (part == 0xE2).any() and b"\xe2\x96\x81" in (whole := part.tobytes()):  # the space's own sign
            texts_ = [whole[a:b].replace(b"\xe2\x96\x81", b" ") for a, b in zip(own[:-1], own[1:], strict=True)]
            part, own = np.frombuffer(b"".join(texts_), np.uint8), np.r_[0, np.cumsum([len(t) for t in texts_])]
        filled = np.diff(own) > 0
        part = np.insert(part, own[:-1][filled], 0x20)  # each text starts as after a space
        own = own + np.r_[0, np.cumsum(filled)]
        starts, ends, ranges = pieces(part, own)
        lines = np.r_[0, np.cumsum(part == 0x0A)]
        total = np.r_[0, np.cumsum(memory.flat[memory.first[e]])] if len(e := memory.of(part, starts, ends)) else np.zeros(1, np.int64)
        out[i:j] = total[ranges[1:]] - total[ranges[:-1]] + lines[own[1:]] - lines[own[:-1]]
    return np.diff(at), out


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row, by the sentencepiece BPE model at ``path``.

    One pass without a shuffle. Null and empty texts have 0 bytes and 0 tokens; a null id stays
    null; repeated rows give a row each; extra columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, tokens = count_tokens(b.column(1), path)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size), pa.array(tokens), pa.array(tokens > limit)], [id_col, "n_bytes", "n_tokens", "over_limit"])
        trim("counts")

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
