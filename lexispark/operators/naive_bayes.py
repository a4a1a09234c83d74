"""Naive Bayes in closed form over the long feature table: one aggregation to fit, one to score."""

from __future__ import annotations

import math
import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import argmax, softmax
from ..session import materialise
from .labels import ClassSize, class_sizes, label_at, log_prior
from .lookup import lookup_join

VARIANTS = ("multinomial", "complement")


def class_sums(features: DataFrame, classes: list, by: Sequence[str] = (), label: str = "label") -> DataFrame:
    """Weight of every term per class: column ``n`` is an array in class order.

    Sums are combined before the shuffle, so a frequent term costs one row per task and class. They are added by hash: an aggregate that
    picks a string, as the name of a term, sorts its rows, and is left to the few sums.
    """
    each = features.groupBy(*by, "idx", "term", label).agg(F.sum("weight").alias("w"))
    sums = [F.sum(F.when(F.col(label) == F.lit(c), F.col("w")).otherwise(0.0)) for c in classes]
    return each.groupBy(*by, "idx").agg(F.any_value("term").alias("term"), F.array(*sums).alias("n"))


def array_sums(values: str, size: int) -> Column:
    """Aggregate that adds arrays element by element."""
    return F.array(*[F.sum(F.col(values)[i]) for i in range(size)])


def weighted_sums(
    features: DataFrame, table: DataFrame, size: int, by: Sequence[str], on: Sequence[str] = ("idx",), max_rows=None
) -> DataFrame:
    """Per ``by`` group the sum of ``weight * logp`` for each element of ``logp``, and of ``weight``."""
    joined = lookup_join(features, table, on, salt_by=by[0], max_rows=max_rows, width=size)
    return joined.groupBy(*by).agg(
        F.array(*[F.sum(F.col("weight") * F.col("logp")[i]) for i in range(size)]).alias("s"),
        F.sum("weight").alias("w"),
    )


class NaiveBayes:
    """Multinomial or complement Naive Bayes on term weights."""

    def __init__(self, variant: str = "multinomial", alpha: float = 1.0, fit_prior: bool = True, key: str = "doc_id"):
        self.variant = variant.lower()
        if self.variant not in VARIANTS:
            raise ValueError(f"unknown Naive Bayes variant '{variant}', expected one of {', '.join(VARIANTS)}")
        self.alpha = float(alpha)
        self.fit_prior = fit_prior
        self.key = key
        self.max_features: int | None = None
        self.classes: list = []
        self.prior: list[float] = []
        self.table: DataFrame | None = None
        self.training_time = 0.0
        self.prediction_time = 0.0

    def get_params(self) -> dict:
        return {"variant": self.variant, "alpha": self.alpha, "fit_prior": self.fit_prior}

    def fit(
        self, features: DataFrame, sizes: list[ClassSize], max_features: int | None = None, label: str = "label"
    ) -> "NaiveBayes":
        """Sum the long training features, which carry the label, into the term table.

        ``sizes`` comes from the training documents, as a document without terms still counts
        for the prior.
        """
        start = time.time()
        self.classes = [c.label for c in sizes]
        k = len(self.classes)
        self.max_features = max_features
        self._set_prior(sizes)
        # one row per vocabulary term, read again by every prediction
        counts = materialise(class_sums(features, self.classes, label=label))
        n_terms, sums = counts.agg(F.count("*"), array_sums("n", k)).first()
        if max_features and max_features > n_terms:
            # vocabulary terms without a training row are smoothed and scored too
            every = features.sparkSession.range(max_features).select(F.col("id").cast("int").alias("idx"))
            absent = every.join(counts, "idx", "left_anti").select("idx", F.lit(None).cast("string").alias("term"), F.array_repeat(F.lit(0.0), k).alias("n"))
            counts, n_terms = counts.select("idx", "term", "n").unionByName(absent), max_features
            sums = sums or [0.0] * k
        n = [F.col("n")[i] for i in range(k)]
        if self.variant == "multinomial":
            smoothed = [math.log(x + self.alpha * n_terms) for x in sums]
            logp = [F.log(n[i] + F.lit(self.alpha)) - F.lit(smoothed[i]) for i in range(k)]
        else:
            term_total = sum(n[1:], n[0]) + F.lit(self.alpha)
            rest = [sum(sums) + self.alpha * n_terms - x for x in sums]
            logp = [-F.log((term_total - n[i]) / F.lit(rest[i])) for i in range(k)]
        self.table = counts.select("idx", "term", F.array(*logp).alias("logp"))
        self.training_time = time.time() - start
        return self

    def _set_prior(self, sizes: list[ClassSize]) -> None:
        # complement weights leave the prior out unless there is a single class
        ignored = self.variant == "complement" and len(sizes) > 1
        self.prior = [0.0] * len(sizes) if ignored else log_prior(sizes, self.fit_prior)

    def log_probabilities(self) -> DataFrame:
        """Long model table ``(label, idx, term, logp)``."""
        classes = F.array(*[F.lit(c) for c in self.classes])
        return self.table.select("idx", "term", F.explode(F.arrays_zip(classes.alias("label"), "logp")).alias("e")).select(
            "e.label", "idx", "term", "e.logp"
        )

    def predict(self, features: DataFrame, docs: DataFrame, keep: Sequence[str] = ("label",)) -> DataFrame:
        """``(key, *keep, prediction, probability)`` for every document, also those without known terms."""
        k = len(self.classes)
        scores = weighted_sums(features, self.table.select("idx", "logp"), k, [self.key], max_rows=self.max_features)
        joint = F.array(*[F.coalesce(F.col("s")[i], F.lit(0.0)) + F.lit(p) for i, p in enumerate(self.prior)])
        dtype = docs.schema["label"].dataType if "label" in docs.columns else None
        position = argmax(F.col("joint"))
        prediction = label_at(position, self.classes, dtype) if dtype else label_at(position, self.classes, "string")
        return (
            docs.select(self.key, *keep)
            .join(scores, self.key, "left")
            .select(self.key, *keep, joint.alias("joint"))
            .select(self.key, *keep, prediction.alias("prediction"), softmax(F.col("joint")).alias("probability"))
        )

    predict_proba = predict

    def timed_predict(self, features: DataFrame, docs: DataFrame, keep: Sequence[str] = ("label",)) -> DataFrame:
        """Predict and record how long scoring every row takes."""
        start = time.time()
        out = self.predict(features, docs, keep)
        out.write.format("noop").mode("overwrite").save()
        self.prediction_time = time.time() - start
        return out

    def save(self, path: str) -> None:
        """Write the term table and a one-row settings table; the written table is used from then on."""
        spark = self.table.sparkSession
        self.table.write.mode("overwrite").parquet(f"{path}/terms")
        self.table = spark.read.parquet(f"{path}/terms")
        kind = "bigint" if isinstance(self.classes[0], int) else "string"
        schema = (
            f"variant string, alpha double, fit_prior boolean, key string, max_features int, classes array<{kind}>, "
            "prior array<double>, training_time double, prediction_time double"
        )
        row = (
            self.variant, self.alpha, self.fit_prior, self.key, self.max_features, self.classes, self.prior,
            self.training_time, self.prediction_time,
        )
        spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "NaiveBayes":
        row = spark.read.parquet(f"{path}/settings").first()
        model = cls(row.variant, row.alpha, row.fit_prior, row.key)
        model.max_features, model.classes, model.prior = row.max_features, list(row.classes), list(row.prior)
        model.training_time, model.prediction_time = row.training_time, row.prediction_time
        model.table = spark.read.parquet(f"{path}/terms")
        return model


def fit_naive_bayes(
    features: DataFrame, docs: DataFrame, max_features: int | None = None, label: str = "label", **params
) -> NaiveBayes:
    """Fit on long features and their documents."""
    return NaiveBayes(**params).fit(features, class_sizes(docs, label), max_features, label)
