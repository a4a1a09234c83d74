"""Labelled corpora: reading, checking, splitting, counting and writing."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ranges import read_csv_ranges

# The fold of every five keys that becomes the test part of a key split.
SPLIT_MODULUS = 5


def spread(df: DataFrame, key: str) -> DataFrame:
    """Cluster a scan by ``key`` when it has fewer splits than the cluster has cores.

    A large table already has enough splits and is left alone, so its texts are not shuffled.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted, key)


def read_table(spark: SparkSession, folder: str, name: str, columns: list[str], key: str | None = None) -> DataFrame:
    """Selected columns of a Parquet table, clustered by ``key`` if the file has few splits."""
    df = spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)
    return spread(df, key) if key else df


def corpus_schema(
    text_column: str = "text", label_column: str = "label", label_type: str = "string", extra: dict | None = None
) -> T.StructType:
    """Explicit schema of a labelled CSV corpus, in file order: ``extra`` columns come last."""
    fields = {text_column: "string", label_column: label_type, **(extra or {})}
    return T._parse_datatype_string(", ".join(f"`{n}` {t}" for n, t in fields.items()))


def read_corpus(
    spark: SparkSession,
    path: str,
    split: str,
    text_column: str = "text",
    label_column: str = "label",
    schema: T.StructType | None = None,
    fmt: str = "csv",
    multi_line: bool = True,
) -> DataFrame:
    """One split of a labelled corpus with a ``split`` column.

    CSV is UTF-8 with a header and double-quoted fields. Fields may hold newlines; large files
    are split between tasks all the same (see ``ranges``), for a second pass over the file. With
    ``multi_line`` off there is one pass, right only if no field holds a newline. Without a schema
    every CSV column is read as text, so no extra pass over the file is made to infer types.
    A row key named ``doc_id`` is added when the file has none.
    """
    try:
        if fmt == "csv" and multi_line:
            df = read_csv_ranges(spark, path, schema)
        elif fmt == "csv":
            reader = (
                spark.read.option("header", True)
                .option("quote", '"')
                .option("escape", '"')
                .option("encoding", "UTF-8")
                .option("enforceSchema", False)
            )
            df = (reader.schema(schema) if schema else reader).csv(path)
        else:
            df = spark.read.format(fmt).load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"{split} data not found: {path}") from error
        raise RuntimeError(f"cannot read {split} data at {path}: {error}") from error
    except Py4JJavaError as error:
        raise RuntimeError(f"cannot read {split} data at {path}: {error}") from error
    require_columns(df, (text_column, label_column), split)
    if "doc_id" not in df.columns:
        key = F.concat_ws(":", F.lit(split), "_row") if "_row" in df.columns else row_key(df, split)
        df = df.withColumn("doc_id", key)
    return df.drop("_row").withColumn("split", F.lit(split))


def row_key(df: DataFrame, split: str) -> Column:
    """A key from the split, the file and the row's place in the scan.

    It is the same every time the same files are read with the same settings; corpora that are
    read in several ways should bring their own ``doc_id``.
    """
    return F.concat_ws(":", F.lit(split), F.input_file_name(), F.monotonically_increasing_id())


def require_columns(df: DataFrame, columns: tuple[str, ...], split: str) -> None:
    for name in columns:
        if name not in df.columns:
            raise ValueError(f"column '{name}' is missing from the {split} data")


def load_data(
    spark: SparkSession,
    train_path: str,
    test_path: str,
    text_column: str = "text",
    label_column: str = "label",
    schema: T.StructType | None = None,
    fmt: str = "csv",
    multi_line: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """The train and test splits."""
    return tuple(
        read_corpus(spark, path, split, text_column, label_column, schema, fmt, multi_line)
        for split, path in (("train", train_path), ("test", test_path))
    )


def key_split(key: Column | str = "doc_id", modulus: int = SPLIT_MODULUS) -> Column:
    """Name of the split a row belongs to: one key in ``modulus`` is test data."""
    key = F.col(key) if isinstance(key, str) else key
    return F.when(F.pmod(key, F.lit(modulus)) == 0, "test").otherwise("train")


def random_split(df: DataFrame, key: str = "doc_id", test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Random train/test split by a seeded hash of the key, the same on every run."""
    slots = 10_000
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")))
    bucket = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(slots))
    return df.withColumn("split", F.when(bucket < int(test_share * slots), "test").otherwise("train"))


def union_splits(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# Counts reported while loading -----------------------------------------------------------------


def split_sizes(docs: DataFrame) -> DataFrame:
    """Rows and columns of every split (the added ``split`` column is not counted)."""
    width = len([c for c in docs.columns if c != "split"])
    return docs.groupBy("split").agg(F.count("*").alias("n_rows"), F.lit(width).cast("bigint").alias("n_columns"))


def value_counts(docs: DataFrame, column: str) -> DataFrame:
    """Rows per split and value; missing values are not counted."""
    return docs.where(F.col(column).isNotNull()).groupBy("split", column).agg(F.count("*").alias("n"))


def dataset_counts(docs: DataFrame) -> DataFrame | None:
    """Rows per split and data set, or nothing when the corpus does not say where rows come from."""
    return value_counts(docs, "dataset") if "dataset" in docs.columns else None


def crosstab(docs: DataFrame, row: str, column: str, values: list) -> DataFrame:
    """Rows per pair of values, one column per entry of ``values``; absent pairs are null."""
    return docs.where(F.col(row).isNotNull()).groupBy(row).pivot(column, values).count()


def missing_texts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Missing texts per split."""
    return docs.groupBy("split").agg(F.count_if(F.col(text_column).isNull()).alias("n_missing"))


def texts_and_labels(docs: DataFrame, text_column: str = "text", label_column: str = "label") -> DataFrame:
    """Key, text and label only."""
    return docs.select("doc_id", F.col(text_column).alias("text"), F.col(label_column).alias("label"))


# Writing ---------------------------------------------------------------------------------------

# Fixed value: marks an empty string in CSV, where it would otherwise read back as missing.
EMPTY_MARK = '""'


def save_processed(train: DataFrame, test: DataFrame, folder: str, fmt: str = "csv") -> None:
    """Write both splits under ``folder`` with all their columns."""
    for name, df in (("processed_train", train), ("processed_test", test)):
        df = df.drop("split")
        df = df.drop(*[f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)])
        if fmt == "csv":
            writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
            # blanks at a text's ends are part of it
            writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            writer.option("emptyValue", EMPTY_MARK).option("nullValue", "").csv(f"{folder}/{name}")
        else:
            df.write.mode("overwrite").format(fmt).save(f"{folder}/{name}")


def load_processed(spark: SparkSession, folder: str, schema: T.StructType | None = None, fmt: str = "csv"):
    """Read back both splits written by :func:`save_processed`."""
    out = []
    for split in ("train", "test"):
        path = f"{folder}/processed_{split}"
        if fmt == "csv":
            df = read_csv_ranges(spark, path, schema, keep_empty=True).drop("_row")
        else:
            df = spark.read.format(fmt).load(path)
        out.append(df.withColumn("split", F.lit(split)))
    return tuple(out)
