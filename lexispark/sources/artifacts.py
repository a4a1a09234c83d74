"""Result tables under one folder, one Parquet table each."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def save_table(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a table and return it as read back, so that later steps start from the file."""
    path = f"{folder}/{name}"
    # result columns are named for people; Parquet names may hold blanks and brackets
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def save_results(tables: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    return {name: save_table(df, folder, name) for name, df in tables.items()}


def load_results(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    """Read back tables written by :func:`save_results`."""
    out = {}
    for name in names:
        try:
            out[name] = spark.read.parquet(f"{folder}/{name}")
        except AnalysisException as error:
            raise FileNotFoundError(f"no result table {folder}/{name}") from error
    return out


def save_csv(df: DataFrame, path: str) -> None:
    """A small result table as CSV with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def save_search(results: DataFrame, folder: str) -> None:
    """Scores of a parameter search, one directory per model; a second search replaces the first one's."""
    results.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model").parquet(f"{folder}/cv_results")
