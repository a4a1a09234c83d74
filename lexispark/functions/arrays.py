"""Array expressions used inside a row, so that they need no shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    Catalyst may inline a column wherever it is used; binding it to a lambda variable keeps
    an expensive value from being computed again for every use.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _shift_zip(grams: Column, tokens: Column, offset: int) -> Column:
    """Append to each gram the token that lies ``offset`` places after the gram's first token."""
    n = F.greatest(F.size(tokens) - offset, F.lit(0))
    return F.zip_with(
        F.slice(grams, F.lit(1), n),
        F.slice(tokens, F.lit(offset + 1), n),
        lambda g, t: F.concat(g, F.lit(" "), t),
    )


def ngrams(tokens: Column, lo: int, hi: int) -> Column:
    """All word n-grams for ``lo <= n <= hi``, words joined with one blank."""
    if lo < 1 or hi < lo:
        raise ValueError(f"invalid n-gram range ({lo}, {hi})")

    def build(t: Column) -> Column:
        grams, wanted = t, []
        for n in range(1, hi + 1):
            if n > 1:
                grams = _shift_zip(grams, t, n - 1)
            if n >= lo:
                wanted.append(grams)
        return wanted[0] if len(wanted) == 1 else F.concat(*wanted)

    return let(tokens, build)


def term_counts(terms: Column) -> Column:
    """``array<struct<term, tf>>`` of one row's terms, by run lengths of the sorted array.

    Counting inside the row replaces ``explode`` + ``groupBy(doc, term)``: no exchange, and
    no hash table keyed by (document, string).
    """

    def runs(s: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)),
        )
        return let(
            starts,
            lambda st: F.transform(
                st,
                lambda p, j: F.struct(
                    F.get(s, p).alias("term"),
                    (F.coalesce(F.get(st, j + 1), F.size(s)) - p).alias("tf"),
                ),
            ),
        )

    empty = F.array().cast("array<struct<term:string,tf:int>>")
    return let(F.sort_array(terms), lambda s: F.when(F.size(s) > 0, runs(s)).otherwise(empty))


def argmax(values: Column) -> Column:
    """Position of the first largest element, counted from 0."""
    return let(values, lambda v: F.array_position(v, F.array_max(v)) - 1)


def softmax(values: Column) -> Column:
    """Normalised exponentials, shifted by the maximum so that they cannot overflow."""

    def scale(e: Column) -> Column:
        total = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
        return let(total, lambda t: F.transform(e, lambda x: x / t))

    def shifted(v: Column) -> Column:
        return let(F.array_max(v), lambda m: F.transform(v, lambda x: F.exp(x - m)))

    return let(let(values, shifted), scale)
