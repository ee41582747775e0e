"""Splitting of UTF-8 buffers into pre-tokens, and per-worker memories of what pre-tokens give.

Natural text repeats its pre-tokens, so a worker tokenizes each distinct one once. The memory is
keyed by 64-bit hash and emptied when it holds ``ROOM`` entries; that costs time, never changes results.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from .textops import U, prefix_hash, span_hash, spans

ROOM = 1_000_000
LETTER, NUMBER, BLANK, OTHER = 1, 2, 3, 0
_classes: list[np.ndarray] = []


def classes() -> np.ndarray:
    """For each code point: letter, number, white space or other."""
    if not _classes:
        import regex

        out = np.zeros(0x110000, np.uint8)
        for low in range(0, 0x110000, 0x10000):
            text = "".join(chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(low, low + 0x10000))
            for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", BLANK)):
                for m in regex.finditer(pattern, text):
                    out[low + m.start() : low + m.end()] = kind
        out[0xD800:0xE000] = OTHER
        _classes.append(out)
    return _classes[0]


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each character's first byte, and its code point."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    first = data[lead]
    cp = first.astype(np.int32)
    wide = np.flatnonzero(first >= 0xC0)
    if len(wide):
        at, b = lead[wide], np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int32)
        f, b1, b2, b3 = b[at], b[at + 1] & 63, b[at + 2] & 63, b[at + 3] & 63
        cp[wide] = np.where(f < 0xE0, (f & 31) << 6 | b1, np.where(f < 0xF0, (f & 15) << 12 | b1 << 6 | b2, (f & 7) << 18 | b1 << 12 | b2 << 6 | b3))
    return lead, np.minimum(cp, 0x10FFFF)


def byte_level(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the pre-tokens of byte-level BPE, which leave no byte out, and each document's range of them.

    The pattern is ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    lead, cp = code_points(data)
    n = len(lead)
    kind = classes()[cp]
    border = np.zeros(n + 1, bool)
    border[np.searchsorted(lead, at)] = True
    change = np.ones(n + 1, bool)
    change[1:n] = kind[1:] != kind[:-1]
    change |= border
    run = np.flatnonzero(change[:-1])
    end = np.r_[run[1:], n]
    what, last = kind[run], end - 1
    space = cp == 0x20
    start = np.zeros(n + 1, bool)
    solid = run[what != BLANK]
    joined = ~border[solid] & space[np.maximum(solid - 1, 0)]  # a space before belongs to the token
    start[solid - joined] = True
    blank = what == BLANK
    a, z, closing = run[blank], last[blank], border[end[blank]]
    start[a[(z > a) | closing | ~space[z]]] = True
    start[z[~closing & ~space[z]]] = True
    # contractions: an apostrophe that starts a token, and its letters
    q = solid[(cp[solid] == 0x27) & ~joined]
    q = q[~border[q + 1]]
    q = q[kind[q + 1] == LETTER] if len(q) else q
    if len(q):
        one, two = cp[q + 1], np.where(border[np.minimum(q + 2, n)], 0, cp[np.minimum(q + 2, n - 1)])
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        start[q[short | long] + 1] = False
        start[q[short] + 2] = True
        start[q[long] + 3] = True
    starts = lead[np.flatnonzero(start[:n])]
    return starts, np.searchsorted(starts, at)


def pieces(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans that no piece of a word-prefix vocabulary crosses: cut before spaces that follow others, and at line ends.

    The line ends themselves are in no span.
    """
    space = data == 0x20
    inside = data != 0x0A
    starts, ends, ranges = spans(inside, at)
    cut = np.flatnonzero(space[1:] & ~space[:-1] & inside[:-1]) + 1
    if len(cut):
        border = np.zeros(len(data) + 1, bool)
        border[starts] = True
        border[cut[~border[cut] & inside[cut]]] = True
        begin = np.flatnonzero(border[:-1])
        stop = np.zeros(len(data) + 1, bool)
        stop[ends] = True
        stop[begin] = True
        ends = np.flatnonzero(stop)
        ends = ends[np.searchsorted(ends, begin, "right")]
        starts, ranges = begin, np.searchsorted(begin, at)
    return starts, ends, ranges


class Memory:
    """What ``make(list of byte strings)`` gives for each distinct span: a ragged array of numbers."""

    def __init__(self, make: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]):
        self.make = make
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, U)
        self.entry = np.zeros(0, np.int64)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The entry of each span."""
        if len(self.known) > ROOM:
            self.clear()
        h = span_hash(prefix_hash(data), starts, ends)
        u, where, back = np.unique(h, return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.known, u), max(0, len(self.known) - 1))
        new = self.known[place] != u if len(self.known) else np.ones(len(u), bool)
        if new.any():
            whole = data.tobytes()
            made = where[new]
            values, counts = self.make([whole[s:e] for s, e in zip(starts[made].tolist(), ends[made].tolist(), strict=True)])
            entries = np.arange(len(counts)) + len(self.count)
            self.first = np.r_[self.first, len(self.flat) + np.r_[0, np.cumsum(counts)[:-1]]].astype(np.int64)
            self.count = np.r_[self.count, counts].astype(np.int64)
            self.flat = np.r_[self.flat, values].astype(np.int32)
            known = np.r_[self.known, u[new]]
            order = np.argsort(known, kind="stable")
            self.known, self.entry = known[order], np.r_[self.entry, entries][order]
            place = np.searchsorted(self.known, u)
        return self.entry[place][back]

    def ragged(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all entries in a row, and the border after each entry."""
        count = self.count[entries]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.first[entries] - (ends - count), count) + np.arange(total)], ends
