"""Benchmark passages in a training corpus, found through a stored positional inverted index.

The index is cut by documents: each shard holds the postings of some megabytes of text, as sorted term hashes with their
word positions, in one row of a Parquet table. A query set is laid against every shard, in blocks of bounded size that are
broadcast, so no postings move between tasks and a term that is in every document costs each shard its own part only. In
a shard the postings of a phrase's rarest term are shifted by its offset and intersected with the shifted lists of the others.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans as sp
from .common import stored, texts

SHARD = 3 << 20
"""Bytes of text a shard; a longer document is a shard of its own."""
QUERY_BLOCK = 4 << 20
"""Bytes of query text laid against the index at once."""
CANDIDATES = 1 << 19
"""Places that are intersected at once."""
INDEX = "shard string, docs array<bigint>, n_words array<bigint>, terms binary, ends binary, positions binary"
MATCHES = "shard string, ord int, doc_id bigint, n_words bigint, runs array<struct<first:bigint,last:bigint>>, items array<string>"


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index of all words (``sp.ALNUM``, A-Z as a-z). Null texts have no words; ids may be null or repeated."""

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = sp.bytes_of(batch.column("_text"))
            for lo, hi in sp.slices(offsets, SHARD):
                a, b = offsets[lo], offsets[hi]
                words = sp.spans(raw[a:b], offsets[lo : hi + 1] - a, sp.ALNUM, fold=True)
                order = np.argsort(words.hash, kind="stable")
                ordered = words.hash[order]
                new = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, int)
                row = {
                    "shard": [uuid.uuid4().hex],
                    "docs": [batch.column("_0")[lo : hi].to_pylist()],
                    "n_words": [sp.counts(words.row, hi - lo)],
                    "terms": [ordered[new].tobytes()],
                    "ends": [np.append(new[1:], len(ordered)).astype("<u4").tobytes() if len(new) else b""],
                    "positions": [order.astype("<u4").tobytes()],
                }
                yield pa.RecordBatch.from_pydict(row, schema=arrow)

    arrow = pa.schema([("shard", pa.string()), ("docs", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int64())), ("terms", pa.binary()), ("ends", pa.binary()), ("positions", pa.binary())])
    return stored(texts(docs, key, text=text).withColumn("_0", F.col("_0").cast("long")).mapInArrow(postings, INDEX), "index")


class Phrases(NamedTuple):
    """Phrases as rows of term hashes: the first ``length`` columns count."""

    item: np.ndarray
    term: np.ndarray
    length: np.ndarray
    names: list


def phrases(names: list[str], column: pa.Array, size: int) -> Phrases:
    """Every run of ``size`` words of every item; an item of fewer, but not none, is one phrase."""
    raw, offsets = sp.bytes_of(column)
    words = sp.spans(raw, offsets, sp.ALNUM, fold=True)
    count = sp.counts(words.row, len(names))
    place = np.arange(len(words.row)) - (np.cumsum(count) - count)[words.row]
    length = np.minimum(count[words.row], size)
    at = np.flatnonzero(place + length <= count[words.row])
    term = np.zeros((len(at), size), np.uint64)
    for i in range(size):
        inside = i < length[at]
        term[inside, i] = words.hash[at[inside] + i]
    return Phrases(words.row[at], term, length[at], names)


class Shard:
    """The postings of one index row."""

    def __init__(self, row: dict):
        self.name, self.docs = row["shard"], row["docs"]
        self.n_words = np.asarray(row["n_words"], np.int64)
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.ends = np.frombuffer(row["ends"], "<u4").astype(np.int64)
        self.positions = np.frombuffer(row["positions"], "<u4").astype(np.int64)
        self.counts = np.diff(self.ends, prepend=0)
        self.edges = np.concatenate([[0], np.cumsum(self.n_words)])
        # one ascending list: the term's rank above the position
        self.keys = (np.repeat(np.arange(len(self.terms)), self.counts) << 32) | self.positions

    def rank(self, term: np.ndarray) -> np.ndarray:
        """Ranks of term hashes, -1 where the shard lacks the term."""
        if not len(self.terms):
            return np.full(term.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
        return np.where(self.terms[at] == term, at, -1)

    def doc(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, position, "right") - 1

    def find(self, ph: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """Phrase number and first position of every exact occurrence inside one document."""
        used = np.arange(ph.term.shape[1]) < ph.length[:, None]
        rank = np.where(used, self.rank(ph.term), -2)
        alive = np.flatnonzero((rank != -1).all(axis=1) & (ph.length > 0))
        if not len(alive):
            return alive, alive
        rank, used = rank[alive], used[alive]
        cost = np.where(used, self.counts[rank], np.iinfo(np.int64).max)
        order = np.argsort(cost, axis=1, kind="stable")
        load = np.cumsum(np.take_along_axis(cost, order[:, :1], 1)[:, 0])
        found = []
        start = 0
        while start < len(alive):
            base = load[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(load, base + CANDIDATES, "right")))
            part = slice(start, stop)
            rows = np.arange(start, stop)
            rarest = rank[rows, order[part, 0]]
            n = self.counts[rarest]
            which = np.repeat(rows, n)
            at = self.positions[sp.ragged(self.ends[rarest] - n, n)] - np.repeat(order[part, 0], n)
            which, at = which[at >= 0], at[at >= 0]
            for i in range(1, ph.term.shape[1]):
                offset = order[which, i]
                need = used[which, offset]
                want = (rank[which, offset] << 32) | (at + offset)
                place = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
                good = ~need | (self.keys[place] == want)
                which, at = which[good], at[good]
            found.append((alive[which], at))
            start = stop
        which, at = (np.concatenate(x) for x in zip(*found, strict=True))
        inside = self.doc(at) == self.doc(at + ph.length[which] - 1)
        return which[inside], at[inside]

    def near(self, terms: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last position of the shortest runs of at most ``width`` words of one document with all the terms."""
        rank = self.rank(np.unique(terms))
        none = np.zeros(0, np.int64)
        if not len(rank) or (rank < 0).any():
            return none, none
        lists = sorted((self.positions[self.ends[r] - self.counts[r] : self.ends[r]] for r in rank), key=len)
        starts = np.unique(np.concatenate(lists))
        rarest = np.append(lists[0], np.iinfo(np.int64).max)
        starts = starts[rarest[np.searchsorted(lists[0], starts)] - starts < width]
        last = starts
        for x in lists:
            last = np.maximum(last, np.append(x, np.iinfo(np.int64).max)[np.searchsorted(x, starts)])
        good = last - starts < width
        good[:-1] &= last[:-1] != last[1:]  # a later start with the same end is shorter
        starts, last = starts[good], last[good]
        inside = self.doc(starts) == self.doc(last)
        return starts[inside], last[inside]


def query_blocks(items: DataFrame, key: str, text: str) -> Iterator[tuple[list[str], pa.Array]]:
    """The items in blocks of about ``QUERY_BLOCK`` bytes, dealt by hash; each block alone is on the driver."""
    q = items.select(F.col(f"`{key}`").cast("string").alias("item"), F.col(f"`{text}`").cast("string").alias("text"))
    size = q.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    blocks = max(1, -(-int(size) // QUERY_BLOCK))
    for i in range(blocks):
        block = q.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == i).toArrow()
        yield block.column("item").to_pylist(), block.column("text").combine_chunks()


def phrase_matches(index: DataFrame, items: DataFrame, size: int = 10, key: str = "item_id", text: str = "text") -> DataFrame:
    """One row per document of the index: ``doc_id, n_words``, merged ``runs`` of matched words (first, last) and ``items``.

    An item with a null id keeps the null among the items; an item without words matches nothing. Without items every
    document has no runs.
    """
    sc = index.sparkSession.sparkContext
    parts = []
    for names, column in query_blocks(items, key, text):
        ph = sc.broadcast(phrases(names, column, size))

        def look(batches: Iterator[pa.RecordBatch], ph=ph) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    yield found(Shard(row), ph.value)

        parts.append(index.mapInArrow(look, MATCHES))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    merged = union.groupBy("shard", "ord").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("runs"))).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return merged.drop("shard", "ord")


ARROW_MATCHES = pa.schema([("shard", pa.string()), ("ord", pa.int32()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))), ("items", pa.list_(pa.string()))])


def found(shard: Shard, ph: Phrases) -> pa.RecordBatch:
    """The matches of a query block in one shard, a row per document."""
    n = len(shard.docs)
    which, at = shard.find(ph)
    marks = np.zeros(shard.edges[-1] + 1, np.int64)
    np.add.at(marks, at, 1)
    np.add.at(marks, at + ph.length[which], -1)
    hit = np.append(np.cumsum(marks[:-1]) > 0, False)
    # runs end at the edges of documents too
    edge = np.zeros(len(hit), bool)
    edge[shard.edges] = True
    first = np.flatnonzero(hit & (~np.concatenate([[False], hit[:-1]]) | edge))
    last = np.flatnonzero(hit[:-1] & (~hit[1:] | edge[1:]))
    doc = shard.doc(first)
    pairs = np.unique(np.stack([shard.doc(at), ph.item[which]], 1), axis=0) if len(at) else np.zeros((0, 2), np.int64)
    runs = [[] for _ in range(n)]
    for d, f, e in zip(doc.tolist(), (first - shard.edges[doc]).tolist(), (last - shard.edges[doc]).tolist(), strict=True):
        runs[d].append({"first": f, "last": e})
    items = [[] for _ in range(n)]
    for d, i in pairs.tolist():
        items[d].append(ph.names[i])
    return pa.RecordBatch.from_pydict({"shard": [shard.name] * n, "ord": list(range(n)), "doc_id": shard.docs, "n_words": shard.n_words, "runs": runs, "items": items}, schema=ARROW_MATCHES)


def proximity_matches(index: DataFrame, items: DataFrame, slop: int = 5, key: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, doc_id, first, last``: shortest runs of at most (distinct words + slop) words with all words of the item.

    Order and repetition inside the item don't count; an item without words matches nothing.
    """
    sc = index.sparkSession.sparkContext
    schema = pa.schema([("item_id", pa.string()), ("doc_id", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])
    parts = []
    for names, column in query_blocks(items, key, text):
        raw, offsets = sp.bytes_of(column)
        words = sp.spans(raw, offsets, sp.ALNUM, fold=True)
        sets = sc.broadcast([(name, np.unique(words.hash[words.row == i])) for i, name in enumerate(names)])

        def look(batches: Iterator[pa.RecordBatch], sets=sets) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    shard = Shard(row)
                    for name, terms in sets.value:
                        first, last = shard.near(terms, len(terms) + slop)
                        doc = shard.doc(first)
                        out = [[name] * len(doc), [shard.docs[d] for d in doc], first - shard.edges[doc], last - shard.edges[doc]]
                        if len(doc):
                            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, out, strict=True)), schema=schema)

        parts.append(index.mapInArrow(look, "item_id string, doc_id bigint, first bigint, last bigint"))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def contamination(docs: DataFrame, items: DataFrame, size: int = 10, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, items, contaminated``; a word inside any occurrence of a window is hit."""
    found = phrase_matches(build_index(docs, key, text), items, size)
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("to"))

    def add(acc, r):  # runs of several blocks can overlap
        return F.struct((acc["n"] + F.greatest(r["last"] - F.greatest(acc["to"] + 1, r["first"]) + 1, F.lit(0))).alias("n"), F.greatest(acc["to"], r["last"]).alias("to"))

    hits = F.aggregate("runs", zero, add, lambda acc: acc["n"])
    return found.select(F.col("doc_id").alias(key), "n_words", hits.alias("n_hit"), "items", "runs", (F.size("runs") > 0).alias("contaminated"))
