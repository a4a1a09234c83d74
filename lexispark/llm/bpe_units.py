"""Byte-pair encoding by a priority queue of merge ranks over a doubly linked list of symbols, and exact decoding.

A pre-token starts as a linked list of one symbol a byte. The queue holds the rank and the left place of every pair that has a merge; the
least is taken, the earlier place first. An entry is stale if its left symbol is gone or the pair that stands there now has another
rank; it is skipped. A merge writes the new symbol to the left place, unlinks the right one and queues the two pairs that arose.
Each distinct pre-token of a worker is merged once. Decoding joins the vocabulary strings and turns their letters into bytes.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans as sp
from .common import texts
from .pieces import PieceCache, hash_ranges
from .token_records import byte_letters, pretoken_starts

SLICE = 1 << 20
"""Bytes of text worked on at once; a longer text is worked on alone."""
PLACE = 1 << 40
"""Places of a pre-token are below this, so a rank and a place are one number."""
ENCODED = "_0 {type}, ids binary, decoded string"


class BytePairs:
    """The merges and strings of a byte-level BPE file (JSON of the ``tokenizers`` library).

    As by that library with its default settings, strings of added tokens are cut out of a text first and have one id each. Files with a
    normaliser, a prefix blank, a dropout, an unknown token, affixes or a byte fallback are refused.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, cut = file["model"], file["pre_tokenizer"] or {}
        extra = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        if model.get("type") != "BPE" or file.get("normalizer") or any(model.get(x) for x in extra):
            raise ValueError("only plain byte-level BPE files are supported")
        if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
            raise ValueError("only byte-level pre-tokens without a prefix blank are supported")
        self.vocab: dict[str, int] = model["vocab"]
        letters = byte_letters()
        self.byte_ids = [self.vocab[letters[b]] for b in range(256)]
        self.width = max(self.vocab.values()) + 1
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for i, m in enumerate(model["merges"]):
            left, right = m.split(" ") if isinstance(m, str) else m
            # of a pair listed twice the later rank counts, as in the library
            self.rank[self.vocab[left] * self.width + self.vocab[right]] = i
            self.made.append(self.vocab[left + right])
        added = {t["content"]: t for t in file.get("added_tokens", []) if t["content"]}
        for t in added.values():
            if t["lstrip"] or t["rstrip"] or t["single_word"]:
                raise ValueError(f"added token {t['content']!r}: lstrip, rstrip and single_word are not supported")
        self.added = {s.encode(): t["id"] for s, t in added.items()}
        # the longest of those that begin at a place
        self.pattern = re.compile(b"|".join(re.escape(x) for x in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.cache = PieceCache()
        self._strings(letters, {i: s for s, i in self.vocab.items()} | {t["id"]: s for s, t in added.items()})

    def _strings(self, letters: dict[int, str], strings: dict[int, str]) -> None:
        """All vocabulary strings as one byte array; a string with a letter that stands for no byte is its own UTF-8."""
        back = {ord(c): b for b, c in letters.items()}
        data = [b""] * (max(strings) + 1)
        for i, s in strings.items():
            data[i] = bytes(back[ord(c)] for c in s) if all(ord(c) in back for c in s) else s.encode()
        self.size = np.array([len(x) for x in data], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(data), np.uint8)

    def merged(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        byte_ids, rank, made, width = self.byte_ids, self.rank, self.made, self.width
        symbol = [byte_ids[b] for b in data]
        n = len(symbol)
        queue = []
        for p in range(n - 1):
            r = rank.get(symbol[p] * width + symbol[p + 1])
            if r is not None:
                queue.append(r * PLACE + p)
        if not queue:
            return symbol
        heapify(queue)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while queue:
            r, p = divmod(heappop(queue), PLACE)
            left, q = symbol[p], after[p]
            if left < 0 or q >= n or rank.get(left * width + symbol[q]) != r:
                continue
            new = symbol[p] = made[r]
            symbol[q] = -1
            q = after[p] = after[q]
            if q < n:
                before[q] = p
                r = rank.get(new * width + symbol[q])
                if r is not None:
                    heappush(queue, r * PLACE + p)
            o = before[p]
            if o >= 0:
                r = rank.get(symbol[o] * width + new)
                if r is not None:
                    heappush(queue, r * PLACE + o)
        return [s for s in symbol if s >= 0]

    def cut_out(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Byte ranges of added tokens, none across two texts."""
        data = raw.tobytes()
        if self.pattern is None or not any(x in data for x in self.added):
            return np.zeros((0, 2), np.int64)
        found = [(a + m.start(), a + m.end()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True) for m in self.pattern.finditer(data[a:b])]
        return np.array(found, np.int64).reshape(-1, 2)

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts (UTF-8 and their offsets) and the number of ids of each."""
        n = len(offsets) - 1
        if not len(raw):
            return np.zeros(0, np.int32), np.zeros(n, np.int64)
        cp = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        at = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
        whole = self.cut_out(raw, offsets)
        edges = np.searchsorted(at, np.union1d(offsets, whole))
        start = at[pretoken_starts(cp, edges)]
        del cp
        # nothing starts inside an added token
        inside = np.searchsorted(whole[:, 0], start, "left") - 1
        start = start[(inside < 0) | (start >= whole[inside, 1])] if len(whole) else start
        end = np.append(start[1:], len(raw))

        def new(places: np.ndarray) -> list[list[int]]:
            units = [raw[start[p] : end[p]].tobytes() for p in places]
            return [[self.added[u]] if u in self.added else self.merged(u) for u in units]

        ids, length = self.cache.encode(hash_ranges(raw, start, end), new)
        row = np.searchsorted(offsets, start, "right") - 1
        return ids, np.bincount(row, length, minlength=n).astype(np.int64)

    def decode(self, ids: np.ndarray, count: np.ndarray) -> list[str]:
        """The text of each run of ids; bytes that are no UTF-8 become U+FFFD, ids without a string stand for nothing."""
        known = ids[(ids >= 0) & (ids < len(self.size))] if len(ids) else ids
        if len(known) < len(ids):
            good = (ids >= 0) & (ids < len(self.size))
            count = np.add.reduceat(np.append(good, False).astype(np.int64), np.minimum(np.cumsum(count) - count, len(ids))) * (count > 0)
        data = self.data[sp.ragged(self.first[known], self.size[known])].tobytes()
        total = np.append(0, np.cumsum(self.size[known]))
        edges = total[np.append(0, np.cumsum(count))].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(edges[:-1], edges[1:], strict=True)]


@lru_cache(maxsize=2)
def byte_pairs(path: str) -> BytePairs:
    """One model a worker process; the path is that of an installed file."""
    return BytePairs(path)


def encode_decode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: its key, ``ids`` (packed as little-endian unsigned 32-bit integers) and ``decoded``, the text that the ids give.

    Null and empty texts have no ids and decode to the empty text. Rows that share an id, or have none, are rows of their own. Other columns
    of ``docs`` are left out, whatever their names. An empty table gives an empty result. A very long text is worked on alone; a pre-token
    of n bytes takes some 60 n bytes while it is merged.
    """
    rows = texts(docs, key, text=text)
    schema = ENCODED.format(type=rows.schema["_0"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = byte_pairs(path)
        for batch in batches:
            raw, offsets = sp.bytes_of(batch.column("_text"))
            for lo, hi in sp.slices(offsets, SLICE):
                a, b = offsets[lo], offsets[hi]
                ids, count = model.encode(raw[a:b], offsets[lo : hi + 1] - a)
                decoded = model.decode(ids, count)
                edges = (4 * np.append(0, np.cumsum(count))).tolist()
                data = ids.astype("<u4").tobytes()
                packed = [data[p:q] for p, q in zip(edges[:-1], edges[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("_0").slice(lo, hi - lo), pa.array(packed, pa.binary()), pa.array(decoded, pa.string())], ["_0", "ids", "decoded"])

    return rows.mapInArrow(run, schema).withColumnRenamed("_0", key)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, ids array<int>`` of every text; see ``encode_decode``."""
    rows = texts(docs, key, text=text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = byte_pairs(path)
        for batch in batches:
            raw, offsets = sp.bytes_of(batch.column("_text"))
            for lo, hi in sp.slices(offsets, SLICE):
                a, b = offsets[lo], offsets[hi]
                ids, count = model.encode(raw[a:b], offsets[lo : hi + 1] - a)
                edges = pa.array(np.append(0, np.cumsum(count)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column("_0").slice(lo, hi - lo), pa.ListArray.from_arrays(edges, pa.array(ids, pa.int32()))], ["_0", "ids"])

    return rows.mapInArrow(run, f"_0 {rows.schema['_0'].dataType.simpleString()}, ids array<int>").withColumnRenamed("_0", key)


def decode(tokens: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, decoded`` of arrays of ids; a null array decodes to the empty text, and ids that the file lacks stand for nothing."""
    rows = tokens.select(F.col(f"`{key}`").alias("_0"), F.coalesce(F.filter(F.col(f"`{ids}`").cast("array<int>"), lambda x: x.isNotNull()), F.array().cast("array<int>")).alias("_ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = byte_pairs(path)
        for batch in batches:
            column = batch.column("_ids")
            edges = column.offsets.to_numpy().astype(np.int64)
            flat = column.values.to_numpy()[edges[0] : edges[-1]]
            yield pa.RecordBatch.from_arrays([batch.column("_0"), pa.array(model.decode(flat, np.diff(edges)), pa.string())], ["_0", "decoded"])

    return rows.mapInArrow(run, f"_0 {rows.schema['_0'].dataType.simpleString()}, decoded string").withColumnRenamed("_0", key)
