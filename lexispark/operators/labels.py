"""Class tables: one row per label, small enough for the driver after a check."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

MAX_CLASSES = 1000


class ClassSize(NamedTuple):
    label: object
    n: int
    first_key: object


def class_sizes(docs: DataFrame, label: str = "label", key: str = "doc_id") -> list[ClassSize]:
    """Size and first key of every class in the labels' natural order.

    Models hold one column per class, so the number of classes is checked here.
    """
    rows = (
        docs.where(F.col(label).isNotNull())
        .groupBy(F.col(label).alias("label"))
        .agg(F.count("*").alias("n"), F.min(key).alias("first_key"))
        .limit(MAX_CLASSES + 1)
        .collect()
    )
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in column '{label}'")
    return sorted((ClassSize(*r) for r in rows), key=lambda c: c.label)


def label_at(position: Column, classes: list, dtype: DataType) -> Column:
    """The label at a class position."""
    return F.get(F.array(*[F.lit(c) for c in classes]), position.cast("int")).cast(dtype)


def position_of(label: Column, classes: list) -> Column:
    """The class position of a label, null for an unknown label."""
    return F.nullif(F.array_position(F.array(*[F.lit(c) for c in classes]), label) - 1, F.lit(-1))


def class_table(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """A broadcast table with at most one row per class."""
    return F.broadcast(df.sparkSession.createDataFrame(rows, schema))


def log_prior(sizes: list[ClassSize], fit_prior: bool = True) -> list[float]:
    total = sum(c.n for c in sizes)
    return [math.log(c.n / total) if fit_prior else -math.log(len(sizes)) for c in sizes]


def balanced_weights(sizes: list[ClassSize]) -> dict:
    """Weight per class that gives every class the same total."""
    total = sum(c.n for c in sizes)
    return {c.label: total / (len(sizes) * c.n) for c in sizes}
