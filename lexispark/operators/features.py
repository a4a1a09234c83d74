"""Word n-gram count and TF-IDF features as a long table, and the hand-over to ML vectors."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import ngrams, term_counts
from ..functions.text import feature_tokens
from ..session import ensure_checkpoint_dir, materialise
from .lookup import lookup_join
from .ordered import row_numbers

METHODS = ("tfidf", "count", "both")
TOKENS_AT_ONCE = 1 << 19
"""Tokens whose n-grams a task counts at once (a longer document is counted alone)."""
IN_ROW_TERMS = 131_072
"""Largest vocabulary that every task holds; terms of a larger one are joined."""


def idf(n_docs: Column, df: Column) -> Column:
    """Smoothed inverse document frequency."""
    return F.log((F.lit(1) + n_docs) / (F.lit(1) + df)) + 1


def sublinear_tf(tf: Column) -> Column:
    return F.lit(1) + F.log(tf)


def _pieces(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, pa.Array, np.ndarray]]:
    """Some rows at a time, their tokens of two characters at least one after another, and the row of each token."""
    for batch in batches:
        if pa.types.is_string(batch.column(column).type):
            batch = batch.set_column(batch.schema.get_field_index(column), column, pc.split_pattern(batch.column(column), " "))
        ends = np.cumsum(batch.column(column).value_lengths().fill_null(0).to_numpy())
        first = 0
        while first < batch.num_rows:
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + TOKENS_AT_ONCE, side="right")))
            piece = batch.slice(first, last - first)
            lists = piece.column(column)
            rows = np.repeat(np.arange(piece.num_rows), lists.value_lengths().fill_null(0).to_numpy())
            flat = lists.flatten()
            long_enough = pc.greater_equal(pc.utf8_length(flat), 2).fill_null(False)
            if pc.all(long_enough).as_py() is False:
                flat, rows = flat.filter(long_enough), rows[long_enough.to_numpy(zero_copy_only=False)]
            yield piece, flat, rows
            first = last


def _grams(flat: pa.Array, rows: np.ndarray, lo: int, hi: int) -> tuple[pa.Array, np.ndarray]:
    """All word n-grams of the tokens, words joined with one blank, and the row of each."""
    grams, found, of = flat, [], []
    for n in range(1, hi + 1):
        if n > 1:
            grams = pc.binary_join_element_wise(grams[:-1], flat[n - 1 :], " ")
        if n >= lo:
            inside = rows[: len(grams)] == rows[n - 1 :]
            found.append(grams.filter(pa.array(inside)))
            of.append(rows[: len(grams)][inside])
    return pa.concat_arrays(found), np.concatenate(of)


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and how often each occurs."""
    values = np.sort(values)
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])[: len(values)])
    return values[first], np.diff(np.append(first, len(values)))


def gram_totals(docs: DataFrame, tokens: Column, lo: int, hi: int, wanted: np.ndarray | None = None) -> DataFrame:
    """``term, df, cf``: rows that hold an n-gram of their tokens, and its occurrences. Tasks add up before anything is shuffled.

    With ``wanted`` only n-grams of buckets marked there are counted.
    """
    if lo < 1 or hi < lo:
        raise ValueError(f"invalid n-gram range ({lo}, {hi})")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, flat, rows in _pieces(batches, "tokens"):
            if wanted is None:
                grams, of = _grams(flat, rows, lo, hi)
            else:
                kept = [(n, first[wanted[bucket]]) for n, first, bucket in _buckets(flat, rows, lo, hi)]
                words = [[flat.take(pa.array(first + i)) for i in range(n)] for n, first in kept]
                grams = pa.concat_arrays([w[0] if len(w) == 1 else pc.binary_join_element_wise(*w, " ") for w in words])
                of = np.concatenate([rows[first] for _, first in kept])
            encoded = grams.dictionary_encode()
            codes, size = encoded.indices.to_numpy().astype(np.int64), len(encoded.dictionary)
            if size:
                once = _distinct(of * size + codes)[0] % size
                totals = [pa.array(np.bincount(c, minlength=size)) for c in (once, codes)]
                yield pa.RecordBatch.from_arrays([encoded.dictionary, *totals], ["term", "df", "cf"])

    counted = docs.select(tokens.alias("tokens")).mapInArrow(count, "term string, df bigint, cf bigint")
    return counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


BUCKETS, BLOCK = 1 << 19, 1 << 15
"""Counters that bound the occurrences of a term from above, and how many of them travel together."""


def _hashes(words: pa.Array) -> np.ndarray:
    """A number of 64 bits for each string, from its bytes alone."""
    words = words.cast(pa.large_binary())
    edges = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    lengths = np.diff(edges)
    if not lengths.sum():
        return np.zeros(len(words), np.uint64)
    data = np.frombuffer(words.buffers()[2], np.uint8)[edges[0] : edges[-1]]
    place = np.arange(len(data)) - np.repeat(edges[:-1] - edges[0], lengths)
    powers = np.cumprod(np.full(lengths.max(), 0x9E3779B97F4A7C15, np.uint64))
    sums = np.append(np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[place]))[edges - edges[0]]
    mixed = np.diff(sums)
    return (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def _buckets(flat: pa.Array, rows: np.ndarray, lo: int, hi: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For every n: first tokens of the n-grams and the bucket of each, which depends on its words only."""
    encoded = flat.dictionary_encode()
    words = _hashes(encoded.dictionary)
    each = words[encoded.indices.to_numpy()] if len(flat) else np.zeros(0, np.uint64)
    out, mixed = [], each.copy()
    for n in range(1, hi + 1):
        if n > 1:
            mixed = mixed[:-1] * np.uint64(0x9E3779B97F4A7C15) + each[n - 1 :]
        if n >= lo:
            first = np.flatnonzero(rows[: len(mixed)] == rows[n - 1 :])
            final = (mixed[first] ^ (mixed[first] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            out.append((n, first, (final >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)))
    return out


def bucket_totals(docs: DataFrame, tokens: Column, lo: int, hi: int) -> np.ndarray:
    """Occurrences of all n-grams by bucket: no term occurs more often than its bucket's total."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(BUCKETS, np.int64)
        for _, flat, rows in _pieces(batches, "tokens"):
            for _, _, bucket in _buckets(flat, rows, lo, hi):
                totals += np.bincount(bucket, minlength=BUCKETS)
        blocks = list(range(0, BUCKETS, BLOCK))
        data = [totals[b : b + BLOCK].tobytes() for b in blocks]
        yield pa.RecordBatch.from_pydict({"block": pa.array(blocks, pa.int64()), "data": pa.array(data, pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for block, data in zip(b.column("block").to_pylist(), b.column("data").to_pylist(), strict=True):
                sums[block] = sums.get(block, 0) + np.frombuffer(data, np.int64)
        if sums:
            yield pa.RecordBatch.from_pydict({"block": pa.array(list(sums), pa.int64()), "data": pa.array([x.tobytes() for x in sums.values()], pa.binary())})

    partial = docs.select(tokens.alias("tokens")).mapInArrow(count, "block bigint, data binary")
    out = np.zeros(BUCKETS, np.int64)
    # as many numbers as there are buckets, whatever the input
    for block, data in partial.repartition(BUCKETS // BLOCK, "block").mapInArrow(add, "block bigint, data binary").collect():
        out[block : block + BLOCK] += np.frombuffer(data, np.int64)
    return out


class FeatureExtractor:
    """Vocabulary of word n-grams fitted on training texts.

    Documents are rows with a unique ``key`` and a text (or ready ``tokens``: an array, or a
    string with blanks between them). Feature
    tables are long: one row per document and kept term, with ``idx`` the alphabetical
    position of the term.
    """

    def __init__(
        self,
        method: str = "tfidf",
        ngram_range: tuple[int, int] = (1, 2),
        max_features: int | None = 5000,
        min_df: int | float = 2,
        max_df: int | float = 0.95,
        key: str = "doc_id",
    ):
        self.method = method.lower()
        if self.method not in METHODS:
            raise ValueError(f"unknown method '{method}', expected one of {', '.join(METHODS)}")
        if isinstance(min_df, int) == isinstance(max_df, int) and max_df < min_df:
            raise ValueError("max_df is below min_df")
        self.ngram_range = tuple(ngram_range)
        self.max_features = max_features
        self.min_df = min_df
        self.max_df = max_df
        self.key = key
        self.vocabulary: DataFrame | None = None
        self.size = 0

    # Terms of a document ------------------------------------------------------------------------

    def _terms(self, tokens: Column) -> Column:
        return term_counts(ngrams(tokens, *self.ngram_range))

    def _raw_tokens(self, docs: DataFrame) -> Column:
        return F.col("tokens") if "tokens" in docs.columns else feature_tokens(F.col("text"))

    def _tokens(self, docs: DataFrame) -> Column:
        # ready tokens are held to the rule for texts: two characters at least
        if "tokens" not in docs.columns:
            return feature_tokens(F.col("text"))
        ready = F.split("tokens", " ") if docs.schema["tokens"].dataType == T.StringType() else F.col("tokens")
        return F.filter(ready, lambda t: F.length(t) >= 2)

    def term_table(self, docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Every term of every document with its count; computed inside the row, no exchange."""
        entry = F.explode(self._terms(self._tokens(docs))).alias("e")
        return docs.select(self.key, *keep, entry).select(self.key, *keep, "e.term", "e.tf")

    def document_frequency(self, docs: DataFrame) -> DataFrame:
        """Documents and occurrences per term over all terms, before pruning."""
        return gram_totals(docs, self._raw_tokens(docs), *self.ngram_range)

    # Fit ------------------------------------------------------------------------------------------

    def pruned(self, docs: DataFrame, totals: DataFrame | None = None) -> DataFrame:
        """Terms within the document-frequency limits, with the number of documents."""
        n_docs = docs.agg(F.count("*").alias("n")).scalar()
        low = F.lit(self.min_df) if isinstance(self.min_df, int) else F.lit(self.min_df) * F.col("n_docs")
        high = F.lit(self.max_df) if isinstance(self.max_df, int) else F.lit(self.max_df) * F.col("n_docs")
        return (
            (self.document_frequency(docs) if totals is None else totals)
            .withColumn("n_docs", n_docs)
            .where((F.col("df") >= low) & (F.col("df") <= high))
        )

    def frequent(self, docs: DataFrame) -> DataFrame | None:
        """Terms within the limits, among them the ``max_features`` commonest; null if all terms have to be counted for them.

        Totals by bucket leave few terms that can be common enough, and these are counted exactly. A count at or above ``least`` lies in a
        counted bucket, so where ``max_features`` terms reach ``least`` no other term comes before them.
        """
        if self.max_features is None or 16 * self.max_features > BUCKETS:
            return None
        totals = bucket_totals(docs, self._raw_tokens(docs), *self.ngram_range)
        least = int(np.sort(totals)[-2 * self.max_features])
        while least > 1:
            counts = gram_totals(docs, self._raw_tokens(docs), *self.ngram_range, totals >= least)
            counts = materialise(counts.where(F.col("cf") >= least))
            terms = self.pruned(docs, counts)
            if terms.count() >= self.max_features:
                return terms
            least //= 4
        return None

    def ranked_vocabulary(self, docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
        """The vocabulary ``(term, idx, df, cf, idf)`` of ``docs`` (or of its ``terms``, if they are counted) as a plan that has not run yet."""
        terms = self.pruned(docs) if terms is None else terms
        if self.max_features is not None:
            terms = terms.orderBy(F.desc("cf"), "term").limit(self.max_features)
            # at most max_features rows are left, so one task can number them
            ranked = terms.withColumn("rank", F.row_number().over(W.orderBy("term")))
        else:
            ranked = row_numbers(materialise(terms.withColumn("_all", F.lit(0))), ["_all"], "term")
        return ranked.select(
            "term", (F.col("rank") - 1).cast("int").alias("idx"), "df", "cf", idf(F.col("n_docs"), F.col("df")).alias("idf")
        )

    def fit(self, docs: DataFrame) -> "FeatureExtractor":
        """Compute the vocabulary in a few passes over ``docs`` and keep it in the checkpoint folder."""
        self._use(materialise(self.ranked_vocabulary(docs, self.frequent(docs))))
        if not self.size:
            raise ValueError("no term is left: lower min_df or raise max_df")
        return self

    def _use(self, vocabulary: DataFrame) -> "FeatureExtractor":
        self.vocabulary = vocabulary
        self.size = vocabulary.count()
        return self

    def _fitted(self) -> DataFrame:
        if self.vocabulary is None:
            raise RuntimeError("fit the extractor first")
        return self.vocabulary

    def feature_names(self) -> DataFrame:
        """Terms in column order."""
        return self._fitted().select("idx", "term").orderBy("idx")

    # Transform ------------------------------------------------------------------------------------

    def counts(self, docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Counts of vocabulary terms; other terms are dropped before anything is shuffled."""
        return lookup_join(self.term_table(docs, keep), self._fitted(), "term", salt_by=self.key, max_rows=self.size, rank_by="cf")

    def transform(self, docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Long feature table ``(key, *keep, idx, term, tf, weight)``.

        ``weight`` is the L2-normalised TF-IDF weight, or the count for method ``count``; ``tf``
        is there in every case, so method ``both`` reads either column.
        """
        columns = [self.key, *keep, "idx", "term", "tf"]
        if self.size <= IN_ROW_TERMS:
            return self._in_row(docs, keep).select(*columns, "weight")
        rows = self.counts(docs, keep)
        if self.method == "count":
            return rows.select(*columns, F.col("tf").cast("double").alias("weight"))
        raw = sublinear_tf(F.col("tf")) * F.col("idf")
        document = W.partitionBy(self.key)
        return rows.select(*columns, raw.alias("raw")).select(
            *columns, (F.col("raw") / F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(document))).alias("weight")
        )

    def _in_row(self, docs: DataFrame, keep: Sequence[str]) -> DataFrame:
        """The feature table by looking the vocabulary up inside the row: nothing is shuffled unless keys repeat, and then one row a document for its norm."""
        lo, hi = self.ngram_range
        # at most ``IN_ROW_TERMS`` rows
        table = self._fitted().select("term", "idx", "idf").orderBy("idx").toArrow()
        terms, weights, size = table.column("term").combine_chunks(), table.column("idf").to_numpy(), self.size
        kept = [self.key, *[c for c in keep if c != self.key]]
        types = {f.name: f.dataType.simpleString() for f in docs.schema}
        counted = self.method == "count"
        # rows of one key are one document; only the keys are read for this
        alone = counted or docs.groupBy(self.key).count().where("count > 1").isEmpty()
        found = "_gram_idx int, _gram_tf int, _gram_weight double" if alone else "_gram_idx array<int>, _gram_tf array<int>, _gram_raw array<double>, _gram_sq double"
        schema = ", ".join(f"`{c}` {types[c]}" for c in kept) + f", {found}"

        def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece, flat, rows in _pieces(batches, "_gram_tokens"):
                grams, of = _grams(flat, rows, lo, hi)
                at = pc.index_in(grams, value_set=terms)
                known = at.is_valid()
                places = of[known.to_numpy(zero_copy_only=False)] * size + at.filter(known).to_numpy()
                places, tf = _distinct(places)
                of, idx = places // size, places % size
                raw = (1 + np.log(tf)) * weights[idx]
                squares = np.bincount(of, raw * raw, piece.num_rows).astype(float)
                numbers = [pa.array(idx, pa.int32()), pa.array(tf, pa.int32())]
                if alone:
                    weight = tf.astype(float) if counted else raw / np.sqrt(squares)[of]
                    repeated = [piece.column(c).take(pa.array(of)) for c in kept]
                    yield pa.RecordBatch.from_arrays([*repeated, *numbers, pa.array(weight)], [*kept, "_gram_idx", "_gram_tf", "_gram_weight"])
                    continue
                edges = pa.array(np.searchsorted(of, np.arange(piece.num_rows + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(edges, x) for x in (*numbers, pa.array(raw))]
                names = [*kept, "_gram_idx", "_gram_tf", "_gram_raw", "_gram_sq"]
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in kept), *lists, pa.array(squares)], names)

        rows = docs.select(*kept, self._raw_tokens(docs).alias("_gram_tokens")).mapInArrow(look_up, schema)
        if alone:
            long = rows.select(*kept, F.col("_gram_idx").alias("idx"), F.col("_gram_tf").alias("tf"), F.col("_gram_weight").alias("weight"))
        else:
            rows = rows.withColumn("_gram_norm", F.sqrt(F.sum("_gram_sq").over(W.partitionBy(self.key))))
            entry = F.explode(F.arrays_zip(F.col("_gram_idx").alias("idx"), F.col("_gram_tf").alias("tf"), F.col("_gram_raw").alias("raw"))).alias("e")
            weight = F.col("e.raw") / F.col("_gram_norm")
            long = rows.select(*kept, "_gram_norm", entry).select(*kept, "e.idx", "e.tf", weight.alias("weight"))
        return long.join(F.broadcast(self._fitted().select("idx", "term")), "idx")

    def fit_transform(self, docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        return self.fit(docs).transform(docs, keep)

    def transform_arrays(self, docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """One row per document with its sorted ``(idx, weight)`` entries; empty documents stay."""
        entries = (
            self.transform(docs)
            .groupBy(self.key)
            .agg(F.array_sort(F.collect_list(F.struct("idx", "weight"))).alias("entries"))
        )
        return docs.select(self.key, *keep).join(entries, self.key, "left")

    def vectors(self, docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Sparse ML vectors in column ``features`` for every document, written to the checkpoint folder.

        A vector is stored as a struct, so a column of such structs that is written is read back as vectors: no Python is involved.
        """
        entry = lambda name, kind: F.coalesce(F.col(f"entries.{name}"), F.array().cast(f"array<{kind}>")).alias("indices" if name == "idx" else "values")
        struct = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(self.size).alias("size"), entry("idx", "int"), entry("weight", "double"))
        rows = self.transform_arrays(docs, keep).select(self.key, *keep, struct.alias("features"))
        ensure_checkpoint_dir(docs.sparkSession)
        path = f"{docs.sparkSession.sparkContext.getCheckpointDir().rstrip('/')}/vectors-{uuid.uuid4().hex}"
        rows.write.parquet(path)
        schema = T.StructType([f for f in rows.schema if f.name != "features"] + [T.StructField("features", VectorUDT())])
        return docs.sparkSession.read.schema(schema).parquet(path)

    # Persistence ----------------------------------------------------------------------------------

    def save(self, path: str) -> None:
        """Write the vocabulary and the settings; the saved table then replaces the computed one."""
        spark = self._fitted().sparkSession
        self._fitted().write.mode("overwrite").parquet(f"{path}/vocabulary")
        settings = [(self.method, *self.ngram_range, self.max_features, repr(self.min_df), repr(self.max_df), self.key)]
        schema = "method string, lo int, hi int, max_features int, min_df string, max_df string, key string"
        spark.createDataFrame(settings, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")
        self._use(spark.read.parquet(f"{path}/vocabulary"))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FeatureExtractor":
        row = spark.read.parquet(f"{path}/settings").first()
        number = lambda text: float(text) if "." in text or "e" in text else int(text)
        extractor = cls(row.method, (row.lo, row.hi), row.max_features, number(row.min_df), number(row.max_df), row.key)
        return extractor._use(spark.read.parquet(f"{path}/vocabulary"))


def extract_features(
    train: DataFrame,
    test: DataFrame,
    method: str = "tfidf",
    ngram_range: tuple[int, int] = (1, 2),
    max_features: int | None = 5000,
    keep: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame, FeatureExtractor]:
    """Fit on the training texts and transform both splits."""
    extractor = FeatureExtractor(method, ngram_range, max_features).fit(train)
    return extractor.transform(train, keep), extractor.transform(test, keep), extractor


def shapes(extractor: FeatureExtractor, docs: DataFrame) -> DataFrame:
    """Documents and features per split."""
    return docs.groupBy("split").agg(F.count("*").alias("n_docs")).withColumn("n_features", F.lit(extractor.size).cast("bigint"))
