"""Words and lines of many texts at once: byte positions and 64-bit hashes as numpy arrays.

A text column arrives as an Arrow string array, whose bytes are one buffer. Spans are runs of the
bytes that a table of 256 flags accepts, so characters outside ASCII must be accepted or refused as a whole (all bytes from
0x80 on). Hashes are polynomial in a fixed odd base modulo 2^64 over random byte values, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
"""Bytes worked on at once; a longer text is cut between two spans."""

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


class Spans(NamedTuple):
    """Spans in text order: row of the text, first byte and end in the batch, hash."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64: every input bit reaches every output bit."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def table(accept) -> np.ndarray:
    """Flags of the 256 bytes."""
    return np.array([bool(accept(b)) for b in range(256)])


SPACED = table(lambda b: b != 32 and not 9 <= b <= 13)
"""Words between white space of ASCII."""
ALNUM = table(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
"""Letters and digits of ASCII and everything beyond ASCII."""
LETTERS = table(lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
LINES = table(lambda b: b != 10)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept between calls while they are of ordinary length."""
    if _powers and len(_powers[0]) >= n:
        return _powers[0], _powers[1]
    size = max(n, 1 << 16)
    made = []
    for base in (_BASE, _INVERSE):
        p = np.full(size, base, np.uint64)
        p[0] = 1
        made.append(np.multiply.accumulate(p))
    if size <= 2 * CHUNK:
        _powers[:] = made
    return made[0], made[1]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and each row's first offset (one more than rows); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    width = np.int64 if column.type in (pa.large_string(), pa.large_binary()) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return raw, off - off[0]


def slices(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one longer row."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), n)
        yield start, stop
        start = stop


def _pieces(flags: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Cuts a long buffer at refused bytes; a span longer than the limit stays whole."""
    start, n = 0, len(flags)
    while start < n:
        stop = min(start + limit, n)
        while stop < n and flags[stop]:
            back = np.flatnonzero(~flags[max(start, stop - 4096) : stop])
            if len(back):
                stop = max(start, stop - 4096) + int(back[-1])
                if stop > start:
                    break
            gap = np.flatnonzero(~flags[stop:])
            stop = stop + int(gap[0]) if len(gap) else n
        yield start, stop
        start = stop


def spans(raw: np.ndarray, offsets: np.ndarray, accept: np.ndarray, fold: bool = False, hashed: bool = True) -> Spans:
    """All spans of accepted bytes; spans never cross two texts. ``fold`` hashes A-Z as a-z."""
    found: list[list[np.ndarray]] = [[], [], []]
    for lo, hi in slices(offsets):
        a, b = int(offsets[lo]), int(offsets[hi])
        if a == b:
            continue
        flags = accept[raw[a:b]]
        cuts = _pieces(flags, CHUNK) if b - a > CHUNK else [(0, b - a)]
        for p, q in cuts:
            f = flags[p:q]
            edge = np.zeros(q - p + 1, bool)
            edge[offsets[(offsets >= a + p) & (offsets <= a + q)] - a - p] = True
            edge[0] = edge[-1] = True
            before = np.empty(q - p, bool)
            before[0], before[1:] = False, f[:-1]
            start = np.flatnonzero(f & (~before | edge[:-1]))
            after = np.empty(q - p, bool)
            after[-1], after[:-1] = False, f[1:]
            end = np.flatnonzero(f & (~after | edge[1:])) + 1
            found[0].append(start + a + p)
            found[1].append(end + a + p)
            if hashed and len(start):
                data = raw[a + p : a + q]
                data = FOLD[data] if fold else data
                up, down = powers(q - p + 1)
                total = np.zeros(q - p + 1, np.uint64)
                np.cumsum(VALUES[data] * up[: q - p], out=total[1:])
                h = (total[end] - total[start]) * down[start]
                found[2].append(mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    start, end = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in found[:2])
    code = np.concatenate(found[2]) if found[2] else np.zeros(0, np.uint64)
    row = np.searchsorted(offsets, start, "right") - 1
    return Spans(row, start, end, code)


def counts(rows: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """How many spans (or how much weight) each text has."""
    return np.bincount(rows, weights, minlength=n).astype(np.int64)


def windows(words: Spans, size: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every run of ``size`` words; a text of fewer words, but not none, has one run of all of them."""
    count = counts(words.row, n)
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    place = np.arange(len(words.row)) - first[words.row]
    length = np.minimum(count[words.row], size)
    keep = np.flatnonzero(place + length <= count[words.row])
    h = np.zeros(len(keep), np.uint64)
    for i in range(size):
        inside = i < length[keep]
        part = np.zeros(len(keep), np.uint64)
        part[inside] = words.hash[keep[inside] + i]
        h = np.where(inside, mix(h * np.uint64(_BASE) + part + np.uint64(i + 1)), h)
    return words.row[keep], h


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The indices of many ranges one after another."""
    length = np.asarray(length, np.int64)
    total = np.cumsum(length)
    if not len(total) or not total[-1]:
        return np.zeros(0, np.int64)
    step = np.repeat(np.asarray(start, np.int64) - np.concatenate([[0], total[:-1]]), length)
    return step + np.arange(total[-1])
