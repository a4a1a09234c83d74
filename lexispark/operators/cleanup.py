"""The clean-up of whole tables: the rules of ``functions.text`` in Arrow batches, for steps that read all texts once."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

AT_ONCE = 16 << 20
"""Bytes of text that a task works on at once (a longer text is worked on alone)."""
ASCII_BLANKS = b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
_KEPT = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ_"
_DROPPED = bytes(c for c in range(128) if c not in _KEPT + ASCII_BLANKS)
_EVEN = bytes.maketrans(ASCII_BLANKS, b" " * len(ASCII_BLANKS))
_URL = re.compile(r"https?://[^\s\x1c-\x1f]+|www\.[^\s\x1c-\x1f]+", re.ASCII)
_TAG = re.compile(tx.TAG_PATTERN)
_OTHER = re.compile(r"[^\x00-\x7f]")
FEW = 32
"""Up to so many different characters of a text are replaced one after another."""


def folds() -> dict[str, str]:
    """What ``fold_unicode`` makes of each character that it changes."""
    source, target, wide, expansion = tx.fold_tables()
    # characters of ``source`` without a partner are marks
    one = {c: target[i] if i < len(target) else "" for i, c in enumerate(source)}
    hangul = {chr(c): unicodedata.normalize("NFKD", chr(c)) for c in range(tx.HANGUL_FIRST, tx.HANGUL_LAST + 1)}
    return one | dict(zip(wide, expansion, strict=True)) | hangul


def _class(codes: Sequence[int]) -> str:
    ends = [i for i in range(1, len(codes)) if codes[i] != codes[i - 1] + 1]
    return "".join(f"{chr(codes[a])}-{chr(codes[b - 1])}" for a, b in zip([0, *ends], [*ends, len(codes)], strict=True))


@lru_cache(maxsize=1)
def plain_classes() -> tuple[str, str]:
    """Characters beyond ASCII that every version of the tables knows and folding keeps: small or caseless letters, and signs, as ranges."""
    small, signs = ("Ll", "Lo"), ("Pc", "Pd", "Ps", "Pe", "Pi", "Pf", "Po", "Sm", "Sc", "Sk", "So")
    old, new, changed = unicodedata.ucd_3_2_0, unicodedata, folds()
    codes = [c for c in range(0x80, 0x10000) if chr(c) not in changed]
    return tuple(_class([c for c in codes if old.category(chr(c)) in kinds and new.category(chr(c)) in kinds]) for kinds in (small, signs))


def _pieces(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ends = np.cumsum(pc.binary_length(b.column(column)).to_numpy())
        first = 0
        while first < b.num_rows:
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + AT_ONCE, side="right")))
            yield b.slice(first, last - first)
            first = last


def processed(docs: DataFrame, stopwords: Sequence[str] = (), min_length: int = 2, text: str = "text", into: str = "tokens") -> DataFrame:
    """``docs`` with ``process_text`` of the column ``text`` as column ``into``, in place of the text.

    A text is lower-cased by Spark. One that holds common letters and signs only, once it is folded, is finished in the batch; others go on
    to Spark's expressions.
    """
    words, least, table, (letters, signs) = sorted(set(stopwords)), max(min_length, 1), folds(), plain_classes()
    passed = [c for c in docs.columns if c not in (text, into)]
    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(f"`{c}` {types[c]}" for c in passed) + (", " if passed else "") + "_clean_text string, _clean_rest string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd, sign, codes = re.compile(f"[^\x00-\x7f{letters}{signs}]"), re.compile(f"[{signs}]+"), str.maketrans(table)
        listed = pa.array([w for w in words if not odd.search(w)], pa.string())

        def folded(t: str) -> str:
            others = set(_OTHER.findall(t))
            if len(others) > FEW:
                return t.translate(codes)
            for c in others:
                if c in table:
                    t = t.replace(c, table[c])
            return t

        for b in _pieces(batches, "_clean_text"):
            plain, rest = [], []
            for t in b.column("_clean_text").to_pylist():
                if not t.isascii():
                    t = folded(t)
                ascii = t.isascii()
                if not ascii and odd.search(t):
                    plain.append(b"")
                    rest.append(t)
                    continue
                if "http" in t or "www." in t:
                    t = _URL.sub("", t)
                if "<" in t:
                    t = _TAG.sub("", t)
                if not ascii:
                    t = sign.sub("", t)
                plain.append(t.encode().translate(_EVEN, _DROPPED))
                rest.append(None)
            lists = pc.split_pattern(pa.array(plain, pa.binary()).cast(pa.string()), " ")
            flat = lists.flatten()
            good = pc.greater_equal(pc.utf8_length(flat), least)
            if len(listed):
                good = pc.and_(good, pc.invert(pc.is_in(pc.ascii_lower(flat), value_set=listed)))
            counts = np.append(0, np.cumsum(good.to_numpy(zero_copy_only=False)))
            edges = counts[np.append(0, np.cumsum(lists.value_lengths().to_numpy()))]
            tokens = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), flat.filter(good)), " ")
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in passed), tokens, pa.array(rest, pa.string())], [*passed, "_clean_text", "_clean_rest"])

    rows = docs.select(*[F.col(f"`{c}`") for c in passed], tx.lower_text(F.col(f"`{text}`")).alias("_clean_text")).mapInArrow(run, schema)
    rest = F.when(F.col("_clean_rest").isNotNull(), F.array_join(tx.kept_tokens(F.col("_clean_rest"), words, min_length), " "))
    return rows.select(*[F.col(f"`{c}`") for c in passed], F.coalesce(rest, "_clean_text").alias(into))
