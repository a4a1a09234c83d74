"""Corpus statistics: the tables behind distribution, frequency and correlation charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import split_blank
from ..session import materialise
from .lookup import lookup_join

HISTOGRAM_BINS = 50
DENSITY_POINTS = 200


def label_distribution(docs: DataFrame, label: str = "label") -> DataFrame:
    """Training and test rows per training label; labels seen only in the test data are left out."""
    counts = docs.where(F.col(label).isNotNull()).groupBy(label).agg(
        F.count_if(F.col("split") == "train").alias("train_n"), F.count_if(F.col("split") == "test").alias("test_n")
    )
    return counts.where(F.col("train_n") > 0)


def word_count(text: Column) -> Column:
    """Words of a text by whitespace; 0 for a missing text."""
    return F.coalesce(F.size(split_blank(text)), F.lit(0))


def length_frequency(docs: DataFrame, by: Sequence[str] = (), text: str = "text") -> DataFrame:
    """Documents per length in words. Every length statistic is derived from this table."""
    size = F.when(F.col(text).isNull(), F.lit(0)).otherwise(word_count(F.col(text)))
    return docs.select(*by, size.alias("n_words")).groupBy(*by, "n_words").agg(F.count("*").alias("n"))


def length_stats(docs: DataFrame, by: Sequence[str] = (), text: str = "text") -> DataFrame:
    """Mean, exact median, longest and shortest document in words."""
    lengths = length_frequency(docs, by, text)
    return (lengths.groupBy(*by) if by else lengths).agg(
        (F.sum(F.col("n_words") * F.col("n")) / F.sum("n")).alias("mean_words"),
        F.expr("percentile(n_words, 0.5, n)").alias("median_words"),
        F.max("n_words").alias("max_words"),
        F.min("n_words").alias("min_words"),
    )


def length_histogram(docs: DataFrame, bins: int = HISTOGRAM_BINS, by: Sequence[str] = (), text: str = "text") -> DataFrame:
    """Documents per equal-width bin between the shortest and the longest; the last bin is closed."""
    lengths = length_frequency(docs, by, text)
    whole = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    low, high = F.min("n_words").over(whole), F.max("n_words").over(whole)
    ranged = lengths.select(*by, "n_words", "n", low.alias("lo"), high.alias("hi"))
    position = F.floor((F.col("n_words") - F.col("lo")) * bins / (F.col("hi") - F.col("lo")))
    bin_no = F.when(F.col("hi") > F.col("lo"), F.least(position, F.lit(bins - 1))).otherwise(F.lit(0))
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    return (
        ranged.select(*by, bin_no.cast("int").alias("bin"), "lo", width.alias("width"), "n")
        .groupBy(*by, "bin")
        .agg(F.sum("n").alias("n_docs"), F.any_value("lo").alias("lo"), F.any_value("width").alias("width"))
        .select(
            *by,
            "bin",
            (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_from"),
            (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_to"),
            "n_docs",
        )
    )


def length_density(docs: DataFrame, points: int = DENSITY_POINTS, by: Sequence[str] = (), text: str = "text") -> DataFrame:
    """Gaussian kernel density of the lengths on an even grid, bandwidth by Scott's rule.

    The kernel is summed over distinct lengths weighted by their documents, not over documents. Where all lengths
    are equal there is no bandwidth, hence no rows.
    """
    lengths = length_frequency(docs, by, text)
    n = F.sum("n")
    x = F.col("n_words").cast("double")
    moments = (lengths.groupBy(*by) if by else lengths).agg(
        n.alias("docs"),
        F.min(x).alias("lo"),
        F.max(x).alias("hi"),
        F.sqrt((F.sum(x * x * F.col("n")) - F.sum(x * F.col("n")) * F.sum(x * F.col("n")) / n) / F.nullif(n - 1, F.lit(0))).alias("sd"),
    )
    if by:
        rows = lengths.join(moments, list(by))
    else:
        one = moments.select(F.struct("*").alias("m")).scalar()
        rows = lengths.withColumn("m", one).select("n_words", "n", "m.*")
    width = F.col("sd") * F.pow(F.col("docs").cast("double"), F.lit(-0.2))
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    spaced = rows.where(F.col("sd") > 0).select(*by, "n_words", "n", "docs", "lo", "hi", width.alias("h"), grid).withColumn(
        "at", F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("point") / (points - 1)
    )
    z = (F.col("at") - F.col("n_words")) / F.col("h")
    kernel = F.exp(-0.5 * z * z) * F.col("n") / (F.col("docs") * F.col("h") * F.sqrt(F.lit(2.0) * F.pi()))
    return spaced.groupBy(*by, "point").agg(F.any_value("at").alias("n_words"), F.sum(kernel).alias("density"))


def word_counts(docs: DataFrame, text: str = "processed_text", by: Sequence[str] = (), stopwords: Sequence[str] = ()):
    """Occurrences per word (and class), optionally without stop-words."""
    words = split_blank(F.col(text))
    if stopwords:
        listed = sorted(set(stopwords))
        words = F.filter(words, lambda w: ~w.isin(listed))
    return docs.select(*by, F.explode(words).alias("word")).groupBy(*by, "word").agg(F.count("*").alias("n"))


def word_frequency(docs: DataFrame, top_n: int = 20, text: str = "processed_text", stopwords: Sequence[str] = ()):
    """The most frequent words."""
    return word_counts(docs, text, (), stopwords).orderBy(F.desc("n"), "word").limit(top_n)


def word_frequency_by_class(docs: DataFrame, top_n: int = 10, text: str = "processed_text", label: str = "label"):
    """The most frequent words of every class."""
    order = W.partitionBy(label).orderBy(F.desc("n"), "word")
    counts = word_counts(docs.where(F.col(label).isNotNull()), text, [label])
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_n)


def feature_means(features: DataFrame, n_docs: Column, top_n: int = 10) -> DataFrame:
    """Terms of highest mean weight over all documents; absent terms count as 0."""
    sums = features.groupBy("idx").agg(F.any_value("term").alias("term"), F.sum("weight").alias("s"))
    return (
        sums.select("term", (F.col("s") / n_docs).alias("mean_weight"))
        .orderBy(F.desc(F.round("mean_weight", 12)), "term")
        .limit(top_n)
    )


def most_variable(features: DataFrame, n_docs: Column, top_n: int = 20) -> DataFrame:
    """Terms with the largest population deviation of the weight, zeros included."""
    sums = features.groupBy("idx").agg(
        F.any_value("term").alias("term"), F.sum("weight").alias("s"), F.sum(F.col("weight") * F.col("weight")).alias("ss")
    )
    rows = sums.withColumn("n_docs", n_docs)
    mean = F.col("s") / F.col("n_docs")
    std = F.sqrt(F.greatest(F.col("ss") / F.col("n_docs") - mean * mean, F.lit(0.0)))
    return (
        rows.select("idx", "term", "s", "ss", "n_docs", std.alias("std_weight"))
        .orderBy(F.desc(F.round("std_weight", 12)), "term")
        .limit(top_n)
    )


def feature_correlation(
    features: DataFrame, n_docs: Column, top_n: int = 20, key: str = "doc_id", lower_only: bool = False
) -> DataFrame:
    """Pearson correlation of the most variable terms over all documents.

    The chosen terms of a document are gathered into one array of at most ``top_n`` entries and
    paired inside the row, so the pairs need no self-join and are summed before the shuffle.
    ``lower_only`` keeps one triangle, by term order, without the diagonal.
    """
    top = materialise(most_variable(features, n_docs, top_n))
    chosen = lookup_join(features.select(key, "idx", "weight"), top.select("idx", "term"), "idx", salt_by=key, max_rows=top_n)
    per_doc = chosen.groupBy(key).agg(F.collect_list(F.struct("term", "weight")).alias("t"))
    pairs = F.flatten(
        F.transform(
            "t",
            lambda a: F.transform(
                "t", lambda b: F.struct(a["term"].alias("x"), b["term"].alias("y"), (a["weight"] * b["weight"]).alias("p"))
            ),
        )
    )
    products = (
        per_doc.select(F.explode(pairs).alias("e"))
        .groupBy(F.col("e.x").alias("term_x"), F.col("e.y").alias("term_y"))
        .agg(F.sum("e.p").alias("p"))
    )
    # top_n rows, so the grid of all pairs is built from one small array
    stats = top.select("term", "s", "ss", "n_docs")
    entries = stats.agg(F.collect_list(F.struct("*")).alias("t"))
    grid = entries.select("t", F.explode("t").alias("a")).select("a", F.explode("t").alias("b"))
    if lower_only:
        grid = grid.where(F.col("a.term") > F.col("b.term"))
    n = F.col("a.n_docs")
    spread = lambda c: F.sqrt(n * F.col(f"{c}.ss") - F.col(f"{c}.s") * F.col(f"{c}.s"))
    joined = grid.select("a", "b", F.col("a.term").alias("term_x"), F.col("b.term").alias("term_y")).join(
        products, ["term_x", "term_y"], "left"
    )
    top_part = n * F.coalesce("p", F.lit(0.0)) - F.col("a.s") * F.col("b.s")
    scale = spread("a") * spread("b")
    return joined.select("term_x", "term_y", F.when(scale > 0, top_part / scale).alias("correlation"))
