"""Documents as arrays of token ids, and lookups that run once for each distinct token.

A dictionary numbers every distinct token of a corpus; the most frequent ones come first. Looking something up for the tokens of a document
takes two steps. Keys of the head (``HEAD`` tokens, which by Zipf's law are almost all of a text) are found in the row, in arrays of a few
megabytes; nothing moves. Only what is left is exploded and joined by shuffle, and no such key is frequent, so no task gets a hot one.
Stop lists, lemmas and the like become a table of the ids they change, made by joining the dictionary and never the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise
from .lookup import MAX_BROADCAST_ROWS, fits_broadcast
from .ordered import row_numbers

HEAD = 131_072
"""Tokens that are looked up in the row: 2 MB of hashes and ids, and their strings where texts are written."""
UNKNOWN, DROPPED = -1, -2
TABLE = "term string, hash bigint, id bigint, n bigint"


class Head:
    """Sorted keys and their values."""

    def __init__(self, keys: np.ndarray, values: np.ndarray | pa.Array):
        order = np.argsort(keys, kind="stable")
        self.keys, self.values = keys[order], pa.array(values).take(pa.array(order))

    def find(self, flat: np.ndarray) -> pa.Array:
        """The value of every key, null where there is none."""
        if not len(self.keys):
            return pa.nulls(len(flat), self.values.type)
        at = np.minimum(np.searchsorted(self.keys, flat), len(self.keys) - 1)
        return self.values.take(pa.array(at, mask=self.keys[at] != flat))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows one after another, and where each row begins (a null row is empty)."""
    return column.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(column.value_lengths().fill_null(0).to_numpy()))


def _listed(edges: np.ndarray, flat: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), flat)


def look_up(
    docs: DataFrame, key: str, column: str, head: Head, kind: str, tail: DataFrame | None = None, least: int | None = None, default: int | None = None
) -> DataFrame:
    """``docs`` with the numbers in ``column`` replaced by their values (of Spark type ``kind``), the order kept.

    ``tail`` holds ``k, v`` for keys that ``head`` lacks; with ``least`` only keys from there on are looked for in it. A key that neither has
    gets ``default``, or stays as it is without one. ``key`` is unique. Columns may have any name but those beginning with ``_dict_``.
    """
    late = tail is not None
    arrow = {"bigint": pa.int64(), "string": pa.string()}[kind]
    kept = [c for c in docs.columns if c != column]
    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(f"`{c}` {types[c]}" for c in kept) + f", _dict_v array<{kind}>, _dict_k array<bigint>"

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, edges = _lists(b.column(column))
            found = head.find(flat)
            missing = found.is_null().to_numpy(zero_copy_only=False)
            rare = missing & (flat >= least) if least is not None else missing
            if not late or least is not None:
                filled = found.to_numpy(zero_copy_only=False).copy() if kind == "string" else found.fill_null(0).to_numpy().copy()
                left = missing & ~rare if late else missing
                filled[left] = default if default is not None else (flat[left] if kind == "bigint" else None)
                found = pa.array(filled, arrow, mask=rare if late else None)
            counts = np.append(0, np.cumsum(rare))[edges]
            keys = pa.array(flat[rare] if late else flat[:0], pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), _listed(edges, found), _listed(counts if late else np.zeros(len(edges)), keys)], [*kept, "_dict_v", "_dict_k"])

    out = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{column}`").alias(column)).mapInArrow(first, schema)
    order = [F.col(f"`{c}`") for c in kept]
    if tail is None:
        return out.select(*order, F.col("_dict_v").alias(column))
    wanted = out.where(F.size("_dict_k") > 0).select(F.col(f"`{key}`").alias("_dict_i"), F.posexplode("_dict_k").alias("pos", "k"))
    values = wanted.join(tail.select("k", "v"), "k", "left").groupBy("_dict_i").agg(F.array_sort(F.collect_list(F.struct("pos", "v", "k"))).alias("_dict_f"))
    joined = out.drop("_dict_k").join(values, F.col(f"`{key}`") == F.col("_dict_i"), "left").drop("_dict_i")
    fallback = F.lit(default).cast(kind) if default is not None else (lambda e: e["k"]) if kind == "bigint" else F.lit(None).cast(kind)

    def value(e: Column) -> Column:
        # a tail value can be null on purpose only where a default is given
        return F.coalesce(e["v"], fallback(e) if callable(fallback) else fallback)

    filled = joined.withColumn("_dict_f", F.transform("_dict_f", value))
    schema = ", ".join(f"`{c}` {types[c]}" for c in kept) + f", _dict_v array<{kind}>"

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v, f = b.column("_dict_v"), b.column("_dict_f")
            flat, found = v.flatten(), f.flatten()
            edges = np.append(0, np.cumsum(v.value_lengths().fill_null(0).to_numpy()))
            if len(found):
                gaps = flat.is_null()
                # every gap of a row with late values is filled from them, in order
                rows = np.repeat(f.value_lengths().fill_null(0).to_numpy() > 0, np.diff(edges))
                flat = flat.to_numpy(zero_copy_only=False).copy() if kind == "string" else flat.fill_null(0).to_numpy().copy()
                flat[gaps.to_numpy(zero_copy_only=False) & rows] = found.to_numpy(zero_copy_only=False)
                flat = pa.array(flat, arrow)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), _listed(edges, flat)], [*kept, "_dict_v"])

    return filled.mapInArrow(second, schema).select(*order, F.col("_dict_v").alias(column))


class TokenDictionary:
    """Ids of all distinct tokens of a corpus: ``table`` is ``term, hash, id, n``; the ``size_head`` commonest have the first ids, in order."""

    def __init__(self, table: DataFrame, seed: int, size_head: int, size: int):
        self.table, self.seed, self.size_head, self.size = table, seed, size_head, size

    def hashed(self, term: Column) -> Column:
        return F.xxhash64(F.lit(self.seed), term)

    @classmethod
    def fit(cls, docs: DataFrame, tokens: str = "tokens", head: int = HEAD) -> "TokenDictionary":
        """One counting pass; the numbered table is written to the checkpoint folder."""
        counts = docs.select(F.explode(tokens).alias("term")).where(F.col("term").isNotNull()).groupBy("term").agg(F.count("*").alias("n"))
        counts = materialise(counts)
        seed = 0
        # two tokens of one hash: another seed parts them
        while not (hashed := materialise(counts.withColumn("hash", F.xxhash64(F.lit(seed), "term")))).groupBy("hash").count().where("count > 1").isEmpty():
            seed += 1
        top = hashed.orderBy(F.desc("n"), "term").limit(head)
        # at most ``head`` rows, so one task can number them
        first = top.select("term", "hash", (F.row_number().over(W.orderBy(F.desc("n"), "term")) - 1).cast("long").alias("id"), "n")
        size = hashed.count()
        if size <= head:
            return cls(materialise(first), seed, size, size)
        first = materialise(first)
        rest = materialise(hashed.join(first.select("hash"), "hash", "left_anti").withColumn("_all", F.lit(0)))
        numbered = row_numbers(rest, ["_all"], "hash").select("term", "hash", (F.col("rank") + head - 1).alias("id"), "n")
        return cls(materialise(first.unionByName(numbered)), seed, head, size)

    def _head(self, key: str, value: str) -> Head:
        rows = self.table.where(F.col("id") < self.size_head).select(F.col(key).alias("k"), F.col(value).alias("v")).toArrow()
        return Head(rows.column("k").to_numpy(), rows.column("v").combine_chunks())

    def _tail(self, key: str, value: str) -> DataFrame | None:
        if self.size == self.size_head:
            return None
        return self.table.where(F.col("id") >= self.size_head).select(F.col(key).alias("k"), F.col(value).alias("v"))

    def encode(self, docs: DataFrame, key: str = "doc_id", tokens: str = "tokens") -> DataFrame:
        """``docs`` with ids in place of the tokens; ``UNKNOWN`` where the dictionary lacks one."""
        hashes = docs.withColumn(tokens, F.transform(tokens, self.hashed))
        return look_up(hashes, key, tokens, self._head("hash", "id"), "bigint", self._tail("hash", "id"), default=UNKNOWN)

    def decode(self, docs: DataFrame, key: str = "doc_id", tokens: str = "tokens") -> DataFrame:
        """The tokens of the ids; null where the dictionary has no such id."""
        return look_up(docs, key, tokens, self._head("id", "term"), "string", self._tail("id", "term"))

    def changed(self, docs: DataFrame, changes: DataFrame, key: str = "doc_id", tokens: str = "tokens") -> DataFrame:
        """``docs`` with the ids changed as ``changes(id, to)`` says: ``DROPPED`` leaves a token out, ids not listed stay."""
        changes = changes.select(F.col("id").alias("k"), F.col("to").alias("v"))
        late = changes.where(F.col("k") >= self.size_head)
        here = changes.where(F.col("k") < self.size_head)
        if fits_broadcast(late, MAX_BROADCAST_ROWS):
            here, late = changes, None
        else:
            late = materialise(late)
        # at most the head's tokens and as many as may be broadcast
        rows = here.toArrow()
        head = Head(rows.column("k").to_numpy(), rows.column("v").combine_chunks())
        out = look_up(docs, key, tokens, head, "bigint", late, least=None if late is None else self.size_head)
        return out.withColumn(tokens, F.filter(tokens, lambda x: x != DROPPED))

    def with_terms(self, terms: DataFrame) -> "TokenDictionary":
        """A dictionary that also has the rows of ``terms(term)``."""
        new = materialise(terms.select("term").distinct().join(self.table.select("term"), "term", "left_anti").withColumn("hash", self.hashed(F.col("term"))))
        if new.isEmpty():
            return self
        numbered = row_numbers(materialise(new.withColumn("_all", F.lit(0))), ["_all"], "term")
        added = numbered.select("term", "hash", (F.col("rank") + self.size - 1).cast("long").alias("id"), F.lit(0).cast("long").alias("n"))
        return TokenDictionary(materialise(self.table.unionByName(added)), self.seed, self.size_head, self.size + new.count())

    # Lists ------------------------------------------------------------------------------------------

    def without(self, words: DataFrame) -> DataFrame:
        """Changes that drop the tokens in ``words(word)``, whatever the case of the token."""
        listed = words.select(F.col("word").alias("_w")).where("_w IS NOT NULL").distinct()
        return self.table.join(listed, F.lower("term") == F.col("_w"), "left_semi").select("id", F.lit(DROPPED).cast("long").alias("to"))

    def to_lemmas(self, first: DataFrame) -> tuple["TokenDictionary", DataFrame]:
        """Changes of tokens to their lemma in ``first(token, lemma)`` (one row a token), and a dictionary that has all lemmas."""
        used = first.join(self.table.select(F.col("term").alias("token"), "id"), "token")
        wider = self.with_terms(used.select(F.col("lemma").alias("term")))
        targets = wider.table.select(F.col("term").alias("lemma"), F.col("id").alias("to"))
        return wider, used.join(targets, "lemma").select("id", "to")
