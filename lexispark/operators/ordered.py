"""Ordered computations inside groups of any size.

A window over a whole group sorts that group in one task. Here the order column is cut into
ranges first; every range is a task of its own, and totals of the ranges before it are added
from a table with one row per (group, range).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MAX_RANGES = 128
_SAMPLES_PER_RANGE = 16


def with_range(df: DataFrame, order: str, n_ranges: int | None = None) -> DataFrame:
    """Add ``_range``, the index of the range a value of ``order`` falls in.

    The cut points are values of the column itself, picked by hash so that the choice does not
    depend on partitioning. They decide the balance of the ranges only, never the result.
    """
    if n_ranges is None:
        n_ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_ranges = max(2, min(n_ranges, MAX_RANGES))
    wanted = n_ranges * _SAMPLES_PER_RANGE
    sample = df.select(order).where(F.col(order).isNotNull()).orderBy(F.xxhash64(order), order).limit(wanted)
    # a few thousand values at most, of which every n-th becomes a cut
    values = sorted({row[0] for row in sample.collect()})
    step = max(1, -(-len(values) // n_ranges))
    cuts = values[step - 1 :: step]
    return df.withColumn("_range", _search(F.col(order), cuts, 0))


def _search(value: Column, cuts: list, first: int) -> Column:
    """Number of cuts below ``value``, plus ``first``, by nested comparisons."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    return F.when(value <= F.lit(cuts[middle]), _search(value, cuts[:middle], first)).otherwise(
        _search(value, cuts[middle + 1 :], first + middle + 1)
    )


def running_sums(
    df: DataFrame,
    group: list[str],
    order: str,
    sums: dict[str, Column],
    n_ranges: int | None = None,
    totals: bool = False,
    following: dict[str, str] | None = None,
) -> DataFrame:
    """Add inclusive running sums within ``group`` by ascending ``order``.

    ``df`` holds one row per (group, order): equal keys must be summed up before. Group
    columns must not be null. ``totals`` adds the sum over the whole group as
    ``<name>_total``; ``following`` maps new columns to columns read from the next row.
    """
    following = following or {}
    ranged = with_range(df, order, n_ranges)
    # one row per (group, range), at most MAX_RANGES rows per group
    per_range = ranged.groupBy(*group, "_range").agg(
        *[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()],
        *[F.min_by(c, order).alias(f"_f_{n}") for n, c in following.items()],
    )
    whole = W.partitionBy(*group)
    ranges = whole.orderBy("_range")
    before = ranges.rowsBetween(W.unboundedPreceding, -1)
    offsets = per_range.select(
        *group,
        "_range",
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums],
        *[F.sum(f"_t_{n}").over(whole).alias(f"{n}_total") for n in sums if totals],
        *[F.lead(f"_f_{n}").over(ranges).alias(f"_n_{n}") for n in following],
    )
    inside = W.partitionBy(*group, "_range").orderBy(order)
    upto = inside.rowsBetween(W.unboundedPreceding, 0)
    return ranged.join(offsets, [*group, "_range"]).select(
        *df.columns,
        *[(F.col(f"_o_{n}") + F.sum(c).over(upto)).alias(n) for n, c in sums.items()],
        *[f"{n}_total" for n in sums if totals],
        *[F.coalesce(F.lead(c).over(inside), F.col(f"_n_{n}")).alias(n) for n, c in following.items()],
    )


def row_numbers(
    df: DataFrame, group: list[str], order: str, name: str = "rank", n_ranges: int | None = None
) -> DataFrame:
    """Add the position (from 1) of every row within its group by ascending unique ``order``."""
    return running_sums(df, group, order, {name: F.lit(1)}, n_ranges)
