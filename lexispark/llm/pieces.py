"""Ids of repeated byte ranges: each distinct range of a worker's texts is encoded once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from . import spans as sp

LIMIT = 500_000
"""Distinct ranges a worker keeps (about 15 MB); then it starts anew."""
IDS = 4_000_000
"""Ids of those ranges that it keeps (16 MB): long ranges have many."""


def hash_ranges(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of ranges of a byte or code point array (see ``spans``)."""
    up, down = sp.powers(len(codes) + 1)
    values = sp.VALUES[codes] if codes.dtype == np.uint8 else sp.mix(codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(values * up[: len(codes)], out=total[1:])
    return sp.mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class PieceCache:
    """Hash of a range to its ids, as sorted hashes and one flat array of ids."""

    def __init__(self):
        self.hash = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int32)
        self.length = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.int32)

    def encode(self, hashes: np.ndarray, encode: Callable[[np.ndarray], list]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the ranges in order and the number of ids of each.

        ``encode`` gets the places (in ``hashes``) of one range of each unknown hash and returns their ids.
        """
        distinct, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hash) > LIMIT or len(self.ids) > IDS:
            self.__init__()
        place = np.searchsorted(self.hash, distinct)
        known = np.zeros(len(distinct), bool)
        inside = place < len(self.hash)
        known[inside] = self.hash[place[inside]] == distinct[inside]
        new = np.flatnonzero(~known)
        if len(new):
            made = encode(at[new])
            length = np.fromiter(map(len, made), np.int64, len(made))
            first = len(self.ids) + np.cumsum(length) - length
            self.ids = np.concatenate([self.ids, np.fromiter((i for m in made for i in m), np.int32, int(length.sum()))])
            self.hash = np.insert(self.hash, place[new], distinct[new])
            self.first = np.insert(self.first, place[new], first)
            self.length = np.insert(self.length, place[new], length)
            place = np.searchsorted(self.hash, distinct)
        length = self.length[place][inverse]
        return self.ids[sp.ragged(self.first[place][inverse], length)], length
