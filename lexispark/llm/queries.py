"""The operators over the given tables: ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import bpe_units as pairs
from . import sentencepiece_units as units
from . import token_records as records
from .common import shared_folder, table
from .conversations import damaged, repaired_digests
from .decontam import contamination
from .hard_negatives import hard_negatives
from .language_id import languages
from .line_dedup import dedup_lines
from .main_text import extract
from .near_dup import near_groups
from .quality import clean_lines
from .secret_scan import scan
from .warc import archived_pages, read_archives, write_archives

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_records(spark, folder):
    out = shared_folder(spark, "tokens")
    path = public_tokenizers.path("byte_bpe_50k.json")
    records.write_records(table(spark, folder, "documents", "doc_id", "text"), out, path, end_id=2)
    return records.sequence_digests(records.read_records(spark, out))


@query
def op2_secret_scan(spark, folder):
    found = scan(table(spark, folder, "documents", "doc_id", "text", "source"))
    value = F.sha2("value", 256).alias("value_sha256")
    return found.select("doc_id", "position", "part", F.col("length").cast("long").alias("length"), value, F.round("score", 6).alias("score"), "kept")


@query
def op3_sentencepiece(spark, folder):
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, folder, "documents", "doc_id", "text")
    back = units.encode_decode(docs, path)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), units.byte_pieces(F.col("ids"), path).alias("n_byte_pieces"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("text_sha256"), same.alias("exact"),
    )


@query
def op4_near_dup(spark, folder):
    return near_groups(table(spark, folder, "documents", "doc_id", "text"))


@query
def op5_quality_rules(spark, folder):
    judged = clean_lines(table(spark, folder, "documents", "doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lost_words", "kept")


@query
def op6_main_text(spark, folder):
    found = extract(table(spark, folder, "pages", "page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op7_decontamination(spark, folder):
    found = contamination(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "benchmark", "item_id", "text"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest, "contaminated")


@query
def op8_warc(spark, folder):
    out = shared_folder(spark, "warc")
    write_archives(table(spark, folder, "pages", "page_id", "url", "html"), out)
    return archived_pages(read_archives(spark, out))


@query
def op9_language_id(spark, folder):
    docs = languages(table(spark, folder, "documents", "doc_id", "text", "lang"))
    return docs.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))


@query
def op10_line_dedup(spark, folder):
    docs = dedup_lines(table(spark, folder, "documents", "doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


@query
def op11_conversation_repair(spark, folder):
    turns = table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    return repaired_digests(damaged(turns), turns)


@query
def op12_bpe(spark, folder):
    back = pairs.encode_decode(table(spark, folder, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    n_tokens = (F.length("ids") / 4).cast("long").alias("n_tokens")
    return back.select("doc_id", n_tokens, F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op13_hard_negatives(spark, folder):
    rows = table(spark, folder, "embeddings", "vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    # a double of that size is whole, and too large for floor()
    whole = F.transform("embedding", lambda x: F.when(F.abs(256 * x.cast("double")) < 2.0**52, F.floor(256 * x.cast("double")).cast("double")).otherwise(256 * x.cast("double")))
    return hard_negatives(rows.select("vec_id", label.alias("label"), whole.alias("vector")), F.col("vec_id") % 100 == 0)
