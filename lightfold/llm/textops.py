"""Vectorised text kernels over the UTF-8 buffers of Arrow string columns.

All functions work on whole texts. A batch is cut at document borders into slices of
half a megabyte, so that temporary arrays stay small; one longer document is a slice alone.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE = 1 << 19
_ODD = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_ODD, -1, 1 << 64)


#: What a worker keeps between tasks, by name: tokenizers and their memories, each with the call that forgets it.
CACHES: dict[str, Callable[[], None]] = {}


def trim(keep: str = "") -> None:
    """Gives memory that a task no longer needs back to the system, so that a worker's next task starts small; of the
    caches only ``keep`` stays."""
    for name, forget in CACHES.items():
        if name != keep:
            forget()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def mix_int(x: int) -> int:
    return int(mix(np.array([x & 0xFFFFFFFFFFFFFFFF], U))[0])


BYTE = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_powers = [np.ones(1, U), np.ones(1, U)]


def _grown(k: int, base: int, n: int) -> np.ndarray:
    if len(_powers[k]) < n:
        p = np.full(max(n, SLICE + 65536), base, U)
        p[0] = 1
        _powers[k] = np.cumprod(p, dtype=U)
    return _powers[k][:n]


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array, and each text's border; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, borders, data = texts.buffers()
    at = np.frombuffer(borders, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def slices(at: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes each."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def spans(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run of ``inside``, none across documents, and each document's range of runs."""
    border = np.zeros(len(inside) + 1, bool)
    border[at] = True
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(inside):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (border[:-1] | ~before))
    ends = np.flatnonzero(inside & (border[1:] | ~after)) + 1
    return starts, ends, np.searchsorted(starts, at)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running sums from which ``span_hash`` takes the hash of any span."""
    n = len(data)
    out = np.zeros(n + 1, U)
    np.cumsum(BYTE[data] * _grown(0, _ODD, n), dtype=U, out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, the same wherever the span stands."""
    h = (sums[ends] - sums[starts]) * _grown(1, _INVERSE, len(sums))[starts]
    return mix(h + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, and each document's range of words."""
    data = LOWER[data]
    starts, ends, ranges = spans(~SPACE[data], at)
    return span_hash(prefix_hash(data), starts, ends), ranges


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each text its distinct ``k``-word shingles as sorted 64-bit hashes.

    A text of fewer words has its whole sequence as one; one without words, or null, none.
    """
    data, at = flat(texts)
    weights = [U(mix_int(7 + i) | 1) for i in range(k)]
    for i, j in slices(at):
        own = at[i : j + 1] - at[i]
        w, r = words(data[at[i] : at[j]], own)
        n = len(w) - k + 1
        if n > 0:
            h = np.zeros(n, U)
            for t in range(k):
                h += w[t : t + n] * weights[t]
            h = mix(h)
        for a, b in zip(r[:-1].tolist(), r[1:].tolist(), strict=True):
            if b - a >= k:
                yield np.unique(h[a : b - k + 1])
            elif b > a:
                x = np.array([b - a], U)
                for t in range(a, b):
                    x = mix(x + w[t : t + 1] * weights[t - a])
                yield x
            else:
                yield np.zeros(0, U)


def planes(x: np.ndarray, width: int = 8) -> bytes:
    """Integers as byte planes, lowest first: the zero planes of small numbers compress to nothing."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unplanes(data: bytes, width: int = 8) -> np.ndarray:
    rows = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((rows.shape[1], 8), np.uint8)
    out[:, :width] = rows.T
    return out.view("<u8").ravel()
