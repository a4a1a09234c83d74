"""Line-first cleaning: rules fail single lines, and a text that would lose too much of itself is rejected.

Everything is counted on the bytes of many texts at once; words are runs without white space of ASCII.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans as sp
from .common import texts

SLICE = 2 << 20
SYMBOLS = sp.table(lambda b: b in b"#*$%&|<>")
BARS = sp.table(lambda b: b in b"|<>")
UPPER = sp.table(lambda b: 65 <= b <= 90)
LOWER = sp.table(lambda b: 97 <= b <= 122)
MARKS = sp.table(lambda b: b == 33)
#: Ends of a sentence: ASCII marks and brackets, and the characters … ” ’ » 。 ！ ？ by their bytes.
ENDS = sp.table(lambda b: b in b".!?:;,\"')]}")
WIDE_ENDS = [x.encode() for x in "…”’»。！？"]
BOILERPLATE = (
    b"all rights reserved", b"accept cookies", b"cookie policy", b"privacy policy", b"terms of use", b"terms of service", b"enable javascript",
    b"click here", b"sign in", b"log in", b"subscribe to", b"share this", b"skip to content", b"back to top", b"read more",
)


class Rules(NamedTuple):
    """Limits of the line rules and of the verdict."""

    symbols: float = 0.5
    """Symbols a word that fail a line, from four symbols on."""
    bars: float = 0.3
    """Bars a word that make a line of navigation, from two bars on."""
    upper: float = 0.7
    """Share of capitals among ASCII letters that fails a line, from 20 letters on."""
    marks: float = 0.3
    """Exclamation marks a word that fail a line, from four on."""
    stub: int = 4
    """A line of fewer words must end like a sentence."""
    boilerplate: int = 30
    """Most words of a line that a boilerplate phrase fails."""
    lost: float = 0.4
    """A text that loses more than this share of its words is rejected."""


NAMES = ("symbols", "navigation", "capitals", "marks", "stub", "boilerplate")


def counted(flags: np.ndarray) -> np.ndarray:
    """Flags before each byte."""
    return np.concatenate([[0], np.cumsum(flags)])


class Measured(NamedTuple):
    base: dict[str, np.ndarray]
    lines: sp.Spans
    fails: np.ndarray
    words: np.ndarray


def measure(raw: np.ndarray, offsets: np.ndarray, rules: Rules) -> Measured:
    """Base counts of every text, and for every line that isn't empty: its rules failed and its words."""
    n = len(offsets) - 1
    words = sp.spans(raw, offsets, sp.SPACED)
    lines = sp.spans(raw, offsets, sp.LINES)
    inside = counted(sp.SPACED[raw] & ((raw & 0xC0) != 0x80))
    symbols = counted(SYMBOLS[raw])

    # words in windows of three that the text has twice
    h = words.hash
    whole = np.flatnonzero(words.row[2:] == words.row[:-2]) if len(h) > 2 else np.zeros(0, int)
    tri = sp.mix(sp.mix(sp.mix(h[whole]) + h[whole + 1]) + h[whole + 2])
    order = np.lexsort((tri, words.row[whole]))
    row, tri = words.row[whole][order], tri[order]
    again = (row[1:] == row[:-1]) & (tri[1:] == tri[:-1])
    twice = np.zeros(len(whole), bool)
    twice[1:] |= again
    twice[:-1] |= again
    covered = np.zeros(len(h), bool)
    at = whole[order[twice]]
    for i in range(3):
        covered[at + i] = True

    # lines with a word that are equal to an earlier one
    first_word = np.searchsorted(words.start, lines.start)
    n_words = np.searchsorted(words.start, lines.end) - first_word
    real = np.flatnonzero(n_words > 0)
    order = real[np.lexsort((lines.start[real], lines.hash[real], lines.row[real]))]
    same = (lines.row[order][1:] == lines.row[order][:-1]) & (lines.hash[order][1:] == lines.hash[order][:-1])
    base = {
        "n_words": sp.counts(words.row, n),
        "word_chars": np.diff(inside[offsets]),
        "n_symbols": np.diff(symbols[offsets]),
        "n_dup_lines": sp.counts(lines.row[order[1:][same]] if len(order) else np.zeros(0, int), n),
        "n_repeat_words": sp.counts(words.row[covered], n),
    }

    def of(total: np.ndarray) -> np.ndarray:
        return total[lines.end] - total[lines.start]

    some = np.maximum(n_words, 1)
    n_symbols, bars, marks = of(symbols), of(counted(BARS[raw])), of(counted(MARKS[raw]))
    upper, lower = of(counted(UPPER[raw])), of(counted(LOWER[raw]))
    fails = np.zeros((len(lines.start), len(NAMES)), bool)
    fails[:, 0] = (n_symbols >= 4) & (n_symbols > rules.symbols * some)
    fails[:, 1] = (bars >= 2) & (bars > rules.bars * some)
    fails[:, 2] = (upper + lower >= 20) & (upper > rules.upper * (upper + lower))
    fails[:, 3] = (marks >= 4) & (marks > rules.marks * some)
    short = np.flatnonzero((n_words > 0) & (n_words < rules.stub))
    if len(short):
        end = words.end[first_word[short] + n_words[short] - 1]
        closed = ENDS[raw[end - 1]]
        for i in np.flatnonzero(~closed & (raw[end - 1] >= 128)):
            closed[i] = raw[max(end[i] - 3, 0) : end[i]].tobytes().endswith(tuple(WIDE_ENDS))
        fails[short, 4] = ~closed
    for m in re.finditer(b"|".join(BOILERPLATE), sp.FOLD[raw].tobytes()):
        i = int(np.searchsorted(lines.start, m.start(), "right")) - 1
        fails[i, 5] = m.end() <= lines.end[i] and n_words[i] <= rules.boilerplate
    fails[n_words == 0] = False
    return Measured(base, lines, fails, n_words)


def base_failed(base: dict[str, np.ndarray]) -> np.ndarray:
    return (base["n_words"] < 50) | (100 * base["n_repeat_words"] > 50 * base["n_words"])


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lost_words")
OUT = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", base_failed boolean, kept boolean, failed map<string,bigint>, cleaned string"


def clean_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Rules = Rules()) -> DataFrame:  # noqa: B008
    """Per row: the base counts, ``n_lost_words``, ``failed`` (lines by rule), the ``cleaned`` text and ``kept``.

    Lines are cut at ``\\n``; one without a word fails no rule and stays. Null and empty texts have no words, so they fail the base rules;
    their cleaned text is empty. Rows with the same id, or none, are judged one by one. An empty table gives an empty result.
    """
    schema = pa.schema([("doc_id", pa.int64())] + [(c, pa.int64()) for c in COUNTS] + [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("failed", pa.map_(pa.string(), pa.int64())), ("cleaned", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = sp.bytes_of(batch.column("_text"))
            for lo, hi in sp.slices(offsets, SLICE):
                a, b, n = offsets[lo], offsets[hi], hi - lo
                data, own = raw[a:b], offsets[lo : hi + 1] - a
                m = measure(data, own, rules)
                bad = m.fails.any(axis=1)
                lost = sp.counts(m.lines.row, n, m.words * bad)
                failed = base_failed(m.base)
                kept = ~failed & (lost <= rules.lost * m.base["n_words"])
                by_rule = np.stack([sp.counts(m.lines.row, n, f) for f in m.fails.T], 1)
                # a failed line goes with the line end after it; if the last line goes, so does the line end that is last then
                keep = np.ones(len(data), bool)
                start, end, row = m.lines.start[bad], m.lines.end[bad], m.lines.row[bad]
                tail = end == own[row + 1]
                keep[sp.ragged(start, end + ~tail - start)] = False
                at = np.flatnonzero(keep)
                stop = np.searchsorted(at, own[row[tail] + 1])
                stop = stop[stop > np.searchsorted(at, own[row[tail]])]
                keep[at[stop - 1][data[at[stop - 1]] == 10]] = False
                edges = np.concatenate([[0], np.cumsum(keep)])[own].astype(np.int32)
                rest = pa.StringArray.from_buffers(n, pa.py_buffer(edges.tobytes()), pa.py_buffer(data[keep].tobytes()))
                failures = [[(name, int(c)) for name, c in zip(NAMES, row, strict=True) if c] for row in by_rule]
                columns = [batch.column("_0").slice(lo, n), *(pa.array(m.base[c]) for c in COUNTS[:-1]), pa.array(lost), pa.array(failed), pa.array(kept), pa.array(failures, schema.field("failed").type), rest]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    out = texts(docs, key, text=text).withColumn("_0", F.col("_0").cast("long")).mapInArrow(run, OUT)
    return out.withColumnRenamed("doc_id", key)
