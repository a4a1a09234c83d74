"""SentencePiece encoding by unigram Viterbi, and decoding.

Pieces and scores come from a model file. Its pieces lie in a double-array trie over their bytes. White space is U+0020 only
and becomes the marker U+2581; every text that isn't empty gets one marker in front. No piece has a marker after another
character, so a text falls apart before each run of markers without changing the best segmentation, and every
distinct unit of a worker's texts is segmented once: short ones all at once, byte by byte in numpy, long ones singly.
A character that no piece covers is written as byte pieces, and so is a marker that stands in the text itself: decoding
returns every text exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans as sp
from .pieces import PieceCache, hash_ranges

MARK = "▁".encode()
UNKNOWN = 10.0
"""An uncovered character scores so much less than the worst piece."""
SHORT = 48
"""Units of more bytes are segmented one by one."""
SLICE = 1 << 20
NONE = np.float32(-np.inf)


class Trie(NamedTuple):
    """State ``s`` goes by byte ``b`` to ``base[s] + b + 1`` if ``check`` there is ``s``; ``value`` is the piece or -1."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray


def double_array(pieces: list[tuple[bytes, int]]) -> Trie:
    """The trie of byte strings with their ids."""
    ordered = sorted(pieces)
    base, check, value = [0], [0], [-1]
    free = hint = 257  # so that no base is negative

    def grow(n: int) -> None:
        if n >= len(base):
            more = n + 257 - len(base)
            base.extend([0] * more)
            check.extend([-1] * more)
            value.extend([-1] * more)

    todo = [(0, 0, len(ordered), 0)]
    for state, lo, hi, depth in todo:
        if lo < hi and len(ordered[lo][0]) == depth:
            value[state] = ordered[lo][1]
            lo += 1
        if lo == hi:
            continue
        groups, start = [], lo
        for i in range(lo + 1, hi + 1):
            if i == hi or ordered[i][0][depth] != ordered[start][0][depth]:
                groups.append((ordered[start][0][depth], start, i))
                start = i
        grow(free)
        while check[free] != -1:
            free += 1
            grow(free)
        # one child fills the next gap; several are tried from where the last search ended
        place = free if len(groups) == 1 else max(free, hint)
        at, tries = place - groups[0][0] - 1, 0
        while True:
            grow(at + 257)
            if check[at + groups[0][0] + 1] == -1 and all(check[at + c + 1] == -1 for c, _, _ in groups):
                break
            at, tries = at + 1, tries + 1
        if tries > 64:
            hint = at + groups[0][0] + 1
        base[state] = at
        for c, a, b in groups:
            check[at + c + 1] = state
            todo.append((at + c + 1, a, b, depth + 1))
    return Trie(*(np.array(x, np.int32) for x in (base, check, value)))


class Model:
    """Pieces as bytes, log scores, ids of the byte pieces, and the trie of what can stand in a text."""

    def __init__(self, pieces: list[bytes], scores: list[float], byte_ids: list[int], special: set[int]):
        plain = [(p, i) for i, p in enumerate(pieces) if i not in special and i not in set(byte_ids) and p]
        self.scores = np.array(scores, np.float32)
        self.trie = double_array(plain)
        self.longest = max(len(p) for p, _ in plain)
        self.unknown = np.float32(min(self.scores[i] for _, i in plain) - UNKNOWN)
        self.byte_ids = np.array(byte_ids, np.int32)
        surface = [b"" if i in special else p.replace(MARK, b" ") for i, p in enumerate(pieces)]
        for b, i in enumerate(byte_ids):
            surface[i] = bytes([b])
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.length = np.array([len(s) for s in surface], np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.cache = PieceCache()
        self._lists = tuple(x.tolist() for x in (*self.trie, self.scores))

    # A unit is bytes in which the marker's three bytes stand for white space.

    def segment(self, unit: bytes) -> list[int]:
        """Best pieces of one unit; an uncovered character is minus one for each of its bytes."""
        base, check, value, scores = self._lists
        n = len(unit)
        best, back, piece = [0.0] + [-np.inf] * n, [0] * (n + 1), [-1] * (n + 1)
        f32, unknown = np.float32, self.unknown
        for p in range(n):
            if unit[p] & 0xC0 == 0x80 or best[p] == -np.inf:
                continue
            here, single, size = best[p], False, _char(unit[p])
            state = 0
            for q in range(p, n):
                to = base[state] + unit[q] + 1
                if check[to] != state:
                    break
                state = to
                if value[to] >= 0:
                    single = single or q + 1 - p == size
                    score = f32(here + f32(scores[value[to]]))
                    if score > best[q + 1]:
                        best[q + 1], back[q + 1], piece[q + 1] = score, p, value[to]
            if not single and p + size <= n:
                score = f32(here + unknown)
                if score > best[p + size]:
                    best[p + size], back[p + size], piece[p + size] = score, p, -1
        out, q = [], n
        while q > 0:
            out += [piece[q]] if piece[q] >= 0 else [-1] * (q - back[q])
            q = back[q]
        return out[::-1]

    def segment_all(self, units: list[bytes]) -> list[list[int]]:
        """Best ids of each unit, byte pieces included."""
        out: list[list[int]] = [[]] * len(units)
        size = np.array([len(u) for u in units])
        short = np.flatnonzero(size <= SHORT)
        for lo in range(0, len(short), 1 << 13):
            part = short[lo : lo + (1 << 13)]
            for i, ids in zip(part, self._short([units[i] for i in part], size[part]), strict=True):
                out[i] = ids
        for i in np.flatnonzero(size > SHORT):
            out[i] = self.segment(units[i])
        for i, ids in enumerate(out):
            if -1 in ids:
                out[i] = self._bytes(units[i], ids)
        return out

    def _bytes(self, unit: bytes, ids: list[int]) -> list[int]:
        """Byte pieces in the place of minus ones."""
        out, p = [], 0
        for i in ids:
            out.append(i if i >= 0 else int(self.byte_ids[unit[p]]))
            p += 1 if i < 0 else len(MARK) * self._marks[i] + int(self.length[i]) - self._marks[i]
        return out

    @property
    def _marks(self) -> np.ndarray:
        """White space characters of each piece."""
        if not hasattr(self, "_m"):
            blanks = np.concatenate([[0], np.cumsum(self.surface == 32)])
            self._m = blanks[self.first + self.length] - blanks[self.first]
            self._m[self.byte_ids] = 0
        return self._m

    def _short(self, units: list[bytes], size: np.ndarray) -> list[list[int]]:
        """The same Viterbi over all units at once, position by position."""
        n, width = len(units), int(size.max(initial=0))
        if not width:
            return [[] for _ in units]
        order = np.argsort(-size, kind="stable")
        size = size[order]
        text = np.zeros((width, n), np.int32)
        flat = np.frombuffer(b"".join(units[i] for i in order), np.uint8)
        column = np.repeat(np.arange(n), size)
        text[np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size), column] = flat
        best = np.full((width + 1, n), NONE, np.float32)
        best[0] = 0
        back, piece = np.zeros((width + 1, n), np.int16), np.full((width + 1, n), -1, np.int32)
        base, check, value = self.trie
        for p in range(width):
            live = np.flatnonzero((size > p) & ((text[p] & 0xC0) != 0x80) & (best[p] > NONE))
            state = np.zeros(len(live), np.int32)
            here = best[p, live]
            chars = _CHAR[text[p, live]]
            single = np.zeros(n, bool)
            walk, first = live, here
            for q in range(p, min(width, p + self.longest)):
                to = base[state] + text[q, walk] + 1
                good = (check[to] == state) & (size[walk] > q)
                walk, state, first = walk[good], to[good], first[good]
                if not len(walk):
                    break
                found = value[state]
                hit = np.flatnonzero(found >= 0)
                if len(hit):
                    w, v = walk[hit], found[hit]
                    single[w[_CHAR[text[p, w]] == q + 1 - p]] = True
                    score = first[hit] + self.scores[v]
                    better = score > best[q + 1, w]
                    w, v = w[better], v[better]
                    best[q + 1, w], back[q + 1, w], piece[q + 1, w] = score[better], p, v
            rest = ~single[live] & (p + chars <= size[live])
            w, to = live[rest], p + chars[rest]
            score = here[rest] + self.unknown
            better = score > best[to, w]
            w, to = w[better], to[better]
            best[to, w], back[to, w], piece[to, w] = score[better], p, -1
        out: list[list[int]] = [[]] * n
        pieces, backs = piece.T.tolist(), back.T.tolist()
        for i in range(n):
            ids, q, ps, bs = [], int(size[i]), pieces[i], backs[i]
            while q > 0:
                ids += [ps[q]] if ps[q] >= 0 else [-1] * (q - bs[q])
                q = bs[q]
            out[order[i]] = ids[::-1]
        return out

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of many texts and the number of each."""
        n = len(offsets) - 1
        full = np.diff(offsets) > 0
        # a blank in front of every text that isn't empty
        data = np.insert(raw, offsets[:-1][full], 32)
        edges = offsets + np.concatenate([[0], np.cumsum(full)])
        blank = data == 32
        before = np.concatenate([[False], blank[:-1]])
        start = blank & ~before
        start[edges[:-1][full]] = True
        start = np.flatnonzero(start)
        end = np.append(start[1:], len(data))
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(n, np.int64)

        def new(places: np.ndarray) -> list[list[int]]:
            units = [data[start[p] : end[p]].tobytes() for p in places]
            odd = [i for i, u in enumerate(units) if MARK in u]
            made = self.segment_all([u.replace(b" ", MARK) for u in units])
            for i in odd:  # a marker of the text's own stays apart from white space
                ids = []
                for k, piece in enumerate(units[i].split(MARK)):
                    ids += self.byte_ids[list(MARK)].tolist() if k else []
                    ids += self.segment_all([piece.replace(b" ", MARK)])[0]
                made[i] = ids
            return made

        ids, length = self.cache.encode(hash_ranges(data, start, end), new)
        row = np.searchsorted(edges, start, "right") - 1
        return ids, np.bincount(row, length, minlength=n).astype(np.int64)

    def decode(self, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of many texts and the first offset of each (one more than texts)."""
        size = self.length[ids]
        data = self.surface[sp.ragged(self.first[ids], size)]
        edges = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(count)])]
        full = np.diff(edges) > 0
        keep = np.ones(len(data), bool)
        lead = edges[:-1][full]
        keep[lead[data[lead] == 32]] = False
        return data[keep], np.concatenate([[0], np.cumsum(keep)])[edges]


def _char(b: int) -> int:
    return 1 if b < 0x80 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4


_CHAR = np.array([_char(b) for b in range(256)])


@lru_cache(maxsize=2)
def load(path: str) -> Model:
    """The model of a file; scores that are negative ranks (as in a file of merges) become ``-log(1 + rank)``."""
    import sentencepiece

    file = sentencepiece.SentencePieceProcessor(model_file=path)
    n = file.get_piece_size()
    names = [file.id_to_piece(i) for i in range(n)]
    scores = np.array([file.get_score(i) for i in range(n)])
    byte_ids = [file.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    special = {i for i in range(n) if file.is_control(i) or file.is_unknown(i) or file.is_unused(i)}
    if scores.min() < -1000:
        scores = -np.log1p(-scores)
    return Model([x.encode() for x in names], scores.tolist(), byte_ids, special)


def byte_pieces(ids: Column, path: str) -> Column:
    """How many of the ids stand for single bytes."""
    lo, hi = int(load(path).byte_ids.min()), int(load(path).byte_ids.max())
    return F.size(F.filter(ids, lambda i: i.between(lo, hi))).cast("long")


# DataFrames ---------------------------------------------------------------------------------------


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    kept = [(c, batch.column(c)) for c in batch.schema.names if c != name]
    return pa.RecordBatch.from_arrays([x for _, x in kept] + [values], [c for c, _ in kept] + [name])


def _type(df: DataFrame, name: str, kind: str) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != name] + [f"`{name}` {kind}"])


def encode(df: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids of each text (replacing a column of that name). Null and empty texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = sp.bytes_of(batch.column(text))
            for lo, hi in sp.slices(offsets, SLICE):
                a, b = offsets[lo], offsets[hi]
                flat, count = load(model).encode(raw[a:b], offsets[lo : hi + 1] - a)
                edges = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
                yield _with_column(batch.slice(lo, hi - lo), ids, pa.ListArray.from_arrays(pa.array(edges), pa.array(flat)))

    return df.mapInArrow(run, _type(df, ids, "array<int>"))


def encode_decode(df: DataFrame, model: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the ids of each text and the text decoded from them, as ``encode`` and ``decode`` give, in one Python worker a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = sp.bytes_of(batch.column(text))
            for lo, hi in sp.slices(offsets, SLICE):
                a, b = offsets[lo], offsets[hi]
                flat, count = load(model).encode(raw[a:b], offsets[lo : hi + 1] - a)
                edges = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
                part = _with_column(batch.slice(lo, hi - lo), ids, pa.ListArray.from_arrays(pa.array(edges), pa.array(flat)))
                yield _with_column(part, decoded, _texts(*load(model).decode(flat, count)))

    kept = df.drop(ids, decoded)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema] + [f"`{ids}` array<int>", f"`{decoded}` string"])
    return kept.mapInArrow(run, schema)


def _texts(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    values = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return pa.array(values, pa.string())


def decode(df: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of each list of ids (replacing a column of that name); null lists and lists of none give empty texts.

    Control and unknown pieces have no text. Bytes that are no UTF-8, which encoding never gives, become U+FFFD.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(ids)
            for lo in range(0, batch.num_rows, 512):
                part = column.slice(lo, 512)
                count = np.diff(part.offsets.to_numpy()) if not part.null_count else np.array([len(x) if x else 0 for x in part.to_pylist()])
                data, edges = load(model).decode(part.flatten().to_numpy(zero_copy_only=False), count)
                yield _with_column(batch.slice(lo, 512), text, _texts(data, edges))

    return df.mapInArrow(run, _type(df, text, "string"))
