"""Language of texts and of spans inside them: script ranges, n-gram scores of words, and Viterbi with a switching penalty.

What is learned is, for each language, how often each hashed run of four bytes inside words occurs over all training
texts, and which scripts its words are in. A word's score in a language is the log probability of its runs; languages without
a share of the word's script are out, unless all are. Viterbi over the words of a text pays ``PENALTY`` for each change.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans as sp
from .common import texts

BUCKETS = 1 << 18
"""Hashed runs of four bytes a language: its model is one MB."""
PENALTY = 10.0
SMOOTHING = 0.5
SHARE = 0.01
"""A language uses a script if so many of its words are in it."""
SLICE = 2 << 20
HELD = 32
"""Languages that a task counts at once."""
SCRIPTS = 16


def _scripts() -> np.ndarray:
    """Script by the first byte of a character: 0 Latin and common, then by ranges of lead bytes."""
    out = np.zeros(256, np.uint8)
    ranges = [(0xCD, 0xCF, 1), (0xD0, 0xD4, 2), (0xD5, 0xD6, 3), (0xD7, 0xD7, 4), (0xD8, 0xDD, 5), (0xE0, 0xE0, 6), (0xE1, 0xE1, 7), (0xE3, 0xE3, 8), (0xE4, 0xE9, 9), (0xEA, 0xED, 10), (0xF0, 0xF4, 11)]
    for lo, hi, script in ranges:
        out[lo : hi + 1] = script
    return out


SCRIPT = _scripts()


def letters_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[sp.Spans, np.ndarray, np.ndarray]:
    """Words (runs of letters), the bucket of the four bytes around every byte, and each word's script."""
    words = sp.spans(raw, offsets, sp.LETTERS, hashed=False)
    b = np.where(sp.LETTERS[raw], sp.FOLD[raw], 0).astype(np.uint32)
    # nothing crosses two texts
    edge = np.zeros(len(b) + 4, bool)
    edge[offsets] = True
    code = b << 8
    if len(b):
        code[:-1] |= np.where(edge[1 : len(b)], 0, b[1:])
        code[1:] |= np.where(edge[1 : len(b)], 0, b[:-1] << 16)
        code[2:] |= np.where(edge[2 : len(b)] | edge[1 : max(len(b) - 1, 1)], 0, b[:-2] << 24)
    code *= np.uint32(2654435761)
    bucket = (code >> np.uint32(14)).view(np.int32)
    script = np.maximum.reduceat(np.append(SCRIPT[raw], 0), np.stack([words.start, words.end], 1).ravel())[::2] if len(words.start) else np.zeros(0, np.uint8)
    return words, bucket, script


class Model(NamedTuple):
    names: list[str]
    logp: np.ndarray
    uses: np.ndarray


def held_out(key: Column) -> Column:
    """Whether a document is kept from training: CRC-32 of its id as text leaves 1 when divided by 3 (not if it has none)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Counts over all rows with a language; the model has a MB a language and is all that the driver gets.

    Rows without a language or text teach nothing. Without any row there is a model of no languages.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for name, total in held.items():
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_pydict({"lang": [name] * len(at), "bucket": at.astype(np.int32), "n": total[at]})
            held.clear()

        for batch in batches:
            raw, offsets = sp.bytes_of(batch.column("_text"))
            names = np.array(batch.column("_0").to_pylist(), object)
            for lo, hi in sp.slices(offsets, SLICE):
                a, b = offsets[lo], offsets[hi]
                own = offsets[lo : hi + 1] - a
                words, bucket, script = letters_of(raw[a:b], own)
                row = np.searchsorted(own, np.arange(b - a), "right") - 1
                inside = sp.LETTERS[raw[a:b]]
                for name in set(names[lo:hi]):
                    if name not in held and len(held) >= HELD:
                        yield from flush()
                    mine = names[lo:hi] == name
                    total = held.setdefault(name, np.zeros(BUCKETS + SCRIPTS, np.int64))
                    total[:BUCKETS] += np.bincount(bucket[inside & mine[row]], minlength=BUCKETS)
                    total[BUCKETS:] += np.bincount(script[mine[words.row]], minlength=SCRIPTS)
        yield from flush()

    source = texts(docs, lang, text=text).where("_0 IS NOT NULL AND _text IS NOT NULL")
    counted = source.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(counted.column("lang").to_pylist()))
    total = np.zeros((len(names), BUCKETS + SCRIPTS))
    at = np.searchsorted(np.array(names), np.array(counted.column("lang").to_pylist(), str)) if names else np.zeros(0, int)
    total[at, counted.column("bucket").to_numpy()] = counted.column("n").to_numpy()
    grams, scripts = total[:, :BUCKETS], total[:, BUCKETS:]
    logp = np.log(grams + SMOOTHING) - np.log(grams.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    uses = scripts >= SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    return Model(names, logp.astype(np.float32), uses & (scripts > 0))


def viterbi(score: np.ndarray, length: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Best label of every word; ``score`` has the words of all texts one after another, ``length`` words a text."""
    label = np.zeros(len(score), np.int32)
    if not len(score) or score.shape[1] < 2:
        return label
    order = np.argsort(-length, kind="stable")
    size = length[order]
    first = (np.cumsum(length) - length)[order]
    size, first = size[size > 0], first[size > 0]
    stay = np.zeros(score.shape, bool)
    source = np.zeros(len(score), np.int32)
    live = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")
    now = score[first]
    final = np.zeros(len(size), np.int32)
    for t in range(1, int(size[0])):
        n = live[t]
        if n < live[t - 1]:
            final[n : live[t - 1]] = now[n : live[t - 1]].argmax(axis=1)
        now = now[:n]
        at = first[:n] + t
        best = now.argmax(axis=1)
        move = now[np.arange(n), best][:, None] - penalty
        stay[at] = now >= move
        source[at] = best
        now = np.maximum(now, move) + score[at]
    final[: len(now)] = now.argmax(axis=1)
    for t in range(int(size[0]) - 1, 0, -1):
        n = live[t]
        at, state = first[:n] + t, final[:n]
        label[at] = state
        final[:n] = np.where(stay[at, state], state, source[at])
    label[first] = final
    return label


def labelled(model: Model, raw: np.ndarray, offsets: np.ndarray) -> tuple[sp.Spans, np.ndarray]:
    """The words of many texts and the language (number) of each."""
    words, bucket, script = letters_of(raw, offsets)
    ends = np.stack([words.start, words.end], 1).ravel()
    score = np.zeros((len(words.start), len(model.names)), np.float32)
    for i in range(len(model.names)):
        if len(ends):
            score[:, i] = np.add.reduceat(np.append(model.logp[i][bucket], np.float32(0)), ends)[::2]
    allowed = model.uses.T[script]
    allowed |= ~allowed.any(axis=1, keepdims=True)
    score[~allowed] -= 1000
    return words, viterbi(score, sp.counts(words.row, len(offsets) - 1))


SPANS = "lang_pred string, score double, spans array<struct<lang:string,start:int,length:int>>"


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``spans`` (replacing columns of those names, in capitals or not).

    ``spans`` are runs of words of one language, from the first to the last code point of their words; ``lang_pred`` has most
    letters in them (ties: the first by name) and ``score`` is its share of letters. A null text or one without a letter is ``und``
    with score 0 and no spans, and so is every text under a model of no languages.
    """
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(model)
    names = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "spans")]
    span = pa.struct([("lang", pa.string()), ("start", pa.int32()), ("length", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            column = batch.column(text)
            raw, offsets = sp.bytes_of(column)
            for lo, hi in sp.slices(offsets, SLICE):
                a, b, n = offsets[lo], offsets[hi], hi - lo
                own = offsets[lo : hi + 1] - a
                data = raw[a:b]
                words, label = labelled(m, data, own)
                size = (words.end - words.start).astype(float)
                k = max(len(m.names), 1)
                weight = np.bincount(words.row * k + label, size, minlength=n * k).reshape(n, k)
                best, total = weight.argmax(axis=1), weight.sum(axis=1)
                # a text without letters of ASCII can still have signs only
                plain = np.concatenate([[0], np.cumsum(sp.LETTERS[data] & (data < 128))])[own]
                unsure = np.flatnonzero((np.diff(plain) == 0) & (total > 0))
                has = (total > 0) & bool(m.names)
                for i in unsure:
                    has[i] &= any(c.isalpha() for c in data[own[i] : own[i + 1]].tobytes().decode("utf-8", "replace"))
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                new = np.ones(len(label), bool)
                new[1:] = (label[1:] != label[:-1]) | (words.row[1:] != words.row[:-1])
                new &= has[words.row]
                keep = has[words.row]
                at = np.flatnonzero(new)
                last = np.append(at[1:], len(label)) - 1
                if len(at):  # the last word before the next kept run, of the same text
                    run_no = np.cumsum(new) - 1
                    last[run_no[keep]] = np.flatnonzero(keep)
                row = words.row[at]
                start = points[words.start[at]] - points[own[row]]
                length = points[words.end[last]] - points[words.start[at]] if len(at) else start
                values = pa.StructArray.from_arrays([pa.array([m.names[i] for i in label[at]], pa.string()), pa.array(start, pa.int32()), pa.array(length, pa.int32())], fields=list(span))
                edges = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int32)
                out = [batch.column(c).slice(lo, n) for c in names]
                out.append(pa.array([m.names[i] if h else "und" for i, h in zip(best, has, strict=True)], pa.string()))
                out.append(pa.array(np.where(has, weight[np.arange(n), best] / np.maximum(total, 1), 0.0)))
                out.append(pa.ListArray.from_arrays(pa.array(edges), values))
                yield pa.RecordBatch.from_arrays(out, [*names, "lang_pred", "score", "spans"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in names] + [SPANS])
    return docs.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(run, schema)


def languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred``, ``score``, ``spans``, learned from the rows that aren't held out."""
    model = train(docs.where(~held_out(F.col(f"`{key}`"))), text, lang)
    return identify(docs, model, text).withColumn("held_out", held_out(F.col(f"`{key}`")))
