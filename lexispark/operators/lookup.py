"""Joins of token-level rows with a lookup table that has one row per key.

Token keys follow Zipf's law: one word can hold a large share of all rows. A small lookup is
broadcast, which no hot key can hurt. Of a larger one that says how frequent its keys are, the most
frequent are broadcast, and the rest, none of which is hot, is joined by shuffle. Without frequencies
the lookup is repeated once per salt, and the rows of one key are spread over the salts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_NUMBERS = 20_000_000  # array elements over all rows, 160 MB of doubles
SALTS = 32


def fits_broadcast(lookup: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> bool:
    """Count the lookup, stopping just past the limit."""
    return lookup.limit(limit + 1).count() <= limit


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    salt_by: Column | str = "doc_id",
    max_rows: int | None = None,
    width: int = 1,
    limit: int = MAX_BROADCAST_ROWS,
    salts: int = SALTS,
    rank_by: str | None = None,
) -> DataFrame:
    """Join ``rows`` with ``lookup`` on ``on`` (inner, left or left_anti).

    ``rank_by`` names the column of a large lookup that says how frequent a key is.
    ``max_rows`` is a bound the caller can prove (a vocabulary limit); without one the lookup
    is counted before it may be broadcast. ``width`` is the length of a row's longest array.
    """
    limit = min(limit, MAX_BROADCAST_NUMBERS // width)
    on = [on] if isinstance(on, str) else list(on)
    small = max_rows <= limit if max_rows is not None else fits_broadcast(lookup, limit)
    if small:
        return rows.join(F.broadcast(lookup), on, how)
    if rank_by is not None:
        head = materialise(lookup.orderBy(F.desc(rank_by), *on).limit(limit))
        tail = lookup.join(F.broadcast(head.select(*on)), on, "left_anti").hint("shuffle_merge")
        rest = rows.join(F.broadcast(head.select(*on)), on, "left_anti").join(tail, on, how)
        return rest if how == "left_anti" else rows.join(F.broadcast(head), on, "inner").unionByName(rest)
    salted_rows = rows.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_rows.join(repeated.hint("shuffle_merge"), [*on, "_salt"], how).drop("_salt")
