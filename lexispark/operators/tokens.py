"""Token steps that need another table: large stop lists and lemma dictionaries.

Both number the tokens once and change ids (see ``dictionary``), unless a stop list is short. Whoever takes several such steps keeps the encoded documents in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dictionary import TokenDictionary

SHORT_LIST = 10_000
"""Longest list that is looked up in the row; a longer one goes through the dictionary."""


def drop_listed(docs: DataFrame, words: DataFrame, key: str = "doc_id", tokens: str = "tokens", dictionary: TokenDictionary | None = None) -> DataFrame:
    """Drop tokens that occur in the table ``words(word)``, ignoring the tokens' case; ``dictionary`` must have all tokens.

    A list of up to ``SHORT_LIST`` words is counted and then a set that every task holds: no dictionary of the tokens is made and nothing is shuffled.
    """
    if dictionary is None:
        # one more than the limit at most
        found = words.select("word").where("word IS NOT NULL").distinct().limit(SHORT_LIST + 1).collect()
        if len(found) <= SHORT_LIST:
            listed, every = sorted(r.word for r in found), F.coalesce(F.col(tokens), F.array().cast("array<string>"))
            return docs.withColumn(tokens, F.filter(every, lambda w: w.isNull() | ~F.lower(w).isin(listed)) if listed else every)
    known = dictionary or TokenDictionary.fit(docs, tokens)
    return known.decode(known.changed(known.encode(docs, key, tokens), known.without(words), key, tokens), key, tokens)


def lemmatize(docs: DataFrame, lemmas: DataFrame, key: str = "doc_id", tokens: str = "tokens", dictionary: TokenDictionary | None = None) -> DataFrame:
    """Replace tokens by their lemma from ``lemmas(token, lemma)``; unlisted tokens stay as they are.

    A token with several lemmas takes the one with the smallest ``rank`` if the table has that column, else the first by name.
    ``dictionary`` must have all tokens.
    """
    order = [F.col(c) for c in ("rank", "lemma") if c in lemmas.columns]
    first = lemmas.where(F.col("lemma").isNotNull()).groupBy("token").agg(F.min_by("lemma", F.struct(*order)).alias("lemma"))
    known = dictionary or TokenDictionary.fit(docs, tokens)
    wider, changes = known.to_lemmas(first)
    return wider.decode(known.changed(known.encode(docs, key, tokens), changes, key, tokens), key, tokens)
