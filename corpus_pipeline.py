"""A corpus from raw documents to token ids, one operator a stage; each stage works on what its predecessor wrote.

Every stage takes ``(spark, docs, sf_dir)`` and returns the columns of ``documents``; the last returns ids and the decoded text.
Rows without an id pass every stage that can judge them by their text alone. Empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.llm import sentencepiece_units as units
from lexispark.llm.common import stored, table
from lexispark.llm.decontam import contamination
from lexispark.llm.language_id import languages
from lexispark.llm.line_dedup import dedup_lines
from lexispark.llm.near_dup import near_groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHINGLE = 5
LEAST_SHARE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, or without one that has half of their letters, go."""
    found = languages(docs.select(*COLUMNS))
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five or more documents hold stay in one; a document that loses all of its text goes."""
    kept = dedup_lines(docs.select(*COLUMNS))
    left = kept.where((F.col("n_dropped") == 0) | (F.trim("kept_text") != ""))
    text = F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return left.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, similarity 0.8) the document with the smallest id stays.

    Rows that share an id are one document, so they stay or go together.
    """
    groups = near_groups(docs, size=SHINGLE)
    gone = groups.where(~F.col("kept")).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten words in a row of a benchmark item go.

    Each row goes by its own text, also without an id or with one that other rows share: rows are known by a hash of id and text.
    """
    keyed = docs.select(*COLUMNS, F.xxhash64("doc_id", "text").alias("_row"))
    found = contamination(keyed.select("_row", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"), key="_row")
    gone = found.where("contaminated").select("_row").distinct()
    return keyed.join(gone, "_row", "left_anti").select(*COLUMNS)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_pieces, ids, decoded, exact``: piece ids, the text decoded from them and whether it is the text itself."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    back = units.encode_decode(docs.select("doc_id", "text"), path)
    exact = F.col("decoded") == F.coalesce("text", F.lit(""))
    return back.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "decoded", exact.alias("exact"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
