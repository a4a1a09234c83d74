"""Reading tables, column checks and the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.session import ensure_checkpoint_dir

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Columns of one of the given tables."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one in ``spark.checkpoint.dir``, which every executor reaches."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: its lineage ends there."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(df: DataFrame, *columns: str, text: str = "text") -> DataFrame:
    """The named columns and the text as ``_text``, apart from whatever else the table has."""
    return df.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(columns)], F.col(f"`{text}`").cast("string").alias("_text"))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with more underscores if a column's name starts like it (names in capitals are the same to Spark)."""
    while any(c.lower().startswith(name) for c in df.columns):
        name = f"_{name}"
    return name
