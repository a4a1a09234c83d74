"""CSV files with line ends inside quotes, read in ranges by any number of tasks.

Whether a line begins inside quotes depends on all text before it. One pass finds for every range how it would leave each of the two
states it can be entered in; a prefix over the ranges (one row each) then fixes the state at every range's start, and a second pass cuts each range
into records. A record belongs to the range it starts in. Only the few pieces of records that cross a range's edge are shuffled, to be joined.

A quote opens a field only at the field's start; ``""`` inside quotes is one quote. Lines end in LF or CRLF; both are kept inside quotes (Spark's own
reader makes LF of CRLF there if lines end in CRLF). Empty
lines outside quotes are no records. A file whose last field is never closed ends with a record of all the text left, up to its last line end.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lookup import fits_broadcast
from ..session import materialise

RANGE = ["_file", "_start", "_length"]
_QUOTED = re.compile(r'"[^"]*(?:""[^"]*)*"(?!")')
_REST = re.compile(r'[^"]*(?:""[^"]*)*"(?!")')
WHOLE, TAIL, OPEN = 0, 1, 2
NO_TEXT = "\0"
"""Stands for a field without text where one of empty quotes is to be told from it."""


def leaves(line: str, inside: bool) -> bool:
    """Whether a line that is entered inside (or outside) quotes ends inside them."""
    at, n = 0, len(line)
    if inside:
        m = _REST.match(line)
        if m is None:
            return True
        at = line.find(",", m.end())
        if at < 0:
            return False
        at += 1
    while at < n:
        if line[at] == '"':
            m = _QUOTED.match(line, at)
            if m is None:
                return True
            at = m.end()
        at = line.find(",", at)
        if at < 0:
            return False
        at += 1
    return False


def _lines(spark: SparkSession, path) -> DataFrame:
    """Every physical line with the range it starts in, in order within each range."""
    place = [F.col(f"_metadata.{c}").alias(n) for c, n in zip(("file_path", "file_block_start", "file_block_length"), RANGE, strict=True)]
    return spark.read.option("lineSep", "\n").text(path).select(*place, "value")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The parts of a batch that lie in one range."""
    if not batch.num_rows:
        return
    file = batch.column("_file").dictionary_encode().indices.to_numpy()
    start = batch.column("_start").to_numpy()
    cut = np.flatnonzero(np.append(True, (file[1:] != file[:-1]) | (start[1:] != start[:-1])))
    for lo, hi in zip(cut, np.append(cut[1:], batch.num_rows), strict=True):
        part = batch.slice(lo, hi - lo)
        yield tuple(part.column(c)[0].as_py() for c in RANGE), part


def range_ends(lines: DataFrame) -> DataFrame:
    """``_file, _start, _length, e0, e1``: the state each range is left in if it is entered outside or inside quotes."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ends = None, (False, True)
        for batch in batches:
            for place, part in _runs(batch):
                if place != at:
                    if at is not None:
                        yield row(at, ends)
                    at, ends = place, (False, True)
                value = part.column("value")
                # a line without a quote leaves the state as it was
                for line in value.filter(pc.match_substring(value, '"')).to_pylist():
                    ends = (leaves(line, ends[0]), leaves(line, ends[1])) if ends[0] != ends[1] else (leaves(line, ends[0]),) * 2
        if at is not None:
            yield row(at, ends)

    def row(place: tuple, ends: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({n: [v] for n, v in zip([*RANGE, "e0", "e1"], [*place, *map(int, ends)], strict=True)})

    return lines.mapInArrow(scan, "_file string, _start bigint, _length bigint, e0 bigint, e1 bigint")


def range_states(ends: DataFrame) -> DataFrame:
    """``_file, _start, _length, _inside``: the state at each range's start, composed over the ranges before it."""
    order = W.partitionBy("_file").orderBy("_start")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    fixes, flips = F.col("e0") == F.col("e1"), (F.col("e0") == 1) & (F.col("e1") == 0)
    counted = ends.withColumn("_flips", F.sum(flips.cast("long")).over(order.rowsBetween(W.unboundedPreceding, 0)))
    # the last range before that forgets its start, and the flips since then
    state = F.coalesce(F.last(F.when(fixes, F.col("e0")), ignorenulls=True).over(before), F.lit(0))
    since = F.coalesce(F.last(F.when(fixes, F.col("_flips")), ignorenulls=True).over(before), F.lit(0))
    flipped = F.coalesce(F.last("_flips").over(before), F.lit(0)) - since
    return counted.select(*RANGE, ((state + flipped) % 2 == 1).alias("_inside"))


def _with_states(lines: DataFrame, states: DataFrame) -> DataFrame:
    if fits_broadcast(states):
        return lines.join(F.broadcast(states), RANGE, "left")
    numbered = lines.withColumn("_n", F.monotonically_increasing_id())
    return numbered.join(states, RANGE, "left").sortWithinPartitions(*RANGE, "_n").drop("_n")


def _records(lines: DataFrame, names: list[str]) -> DataFrame:
    """``_file, _start, _ord, _kind, _first, _text`` of whole records (the header is checked and left out) and of pieces."""
    schema = "_file string, _start bigint, _ord bigint, _kind bigint, _first boolean, _text string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, inside, held, kind, ord_, out = None, False, [], WHOLE, 0, []

        def add(kind: int, text: str) -> None:
            nonlocal ord_
            first = at[1] == 0 and ord_ == 0
            ord_ += kind != TAIL
            text = text.removeprefix("﻿") if first else text
            if kind == WHOLE and first:
                _check_header(text, names, at[0])
            elif kind != WHOLE or text:
                out.append((at[0], at[1], ord_, kind, first, text))

        def close() -> None:
            """What is left at a range's end is a piece."""
            nonlocal held
            if held:
                add(OPEN if kind == WHOLE else TAIL, "\n".join(held))
                held = []

        def flush() -> pa.RecordBatch:
            nonlocal out
            rows, out = out, []
            return pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*rows, strict=True)], names=[c.split()[0] for c in schema.split(", ")])

        for batch in batches:
            for place, part in _runs(batch):
                if place != at:
                    if at is not None:
                        close()
                    at, ord_ = place, 0
                    inside = part.column("_inside")[0].as_py()
                    kind = TAIL if inside else WHOLE
                    if inside is None:
                        raise RuntimeError("the ranges of a file changed between two passes; set spark.sql.files.minPartitionNum to keep them")
                value = part.column("value")
                quoted = pc.match_substring(value, '"').to_pylist()
                for line, q in zip(value.to_pylist(), quoted, strict=True):
                    if q:
                        inside = leaves(line, inside)
                    if inside:
                        held.append(line)
                        continue
                    held.append(line.removesuffix("\r"))
                    # an empty tail is a line end
                    add(kind, "\n".join(held))
                    held, kind = [], WHOLE
                if len(out) > 2000:
                    yield flush()
        if at is not None:
            close()
        if out:
            yield flush()

    return lines.mapInArrow(cut, schema)


def _check_header(text: str, names: list[str], file: str) -> None:
    found = next(csv.reader([text.removesuffix("\r")]), [])
    if found != names:
        raise ValueError(f"the header of {file} is {found}, expected {names}")


def header_of(spark: SparkSession, path) -> list[str]:
    """Column names of the first file."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
    return reader.csv(path).columns


def read_csv_ranges(spark: SparkSession, path, schema: T.StructType | None = None, keep_empty: bool = False) -> DataFrame:
    """The rows of CSV files with a header, and ``_row``, a key of file, range and place.

    Fields are parsed as by Spark's reader; without a schema all are strings. An empty field is null, also in quotes unless ``keep_empty``. Every file must have the same header, and the
    names of ``schema`` must be those of the header, in order. Empty files give no rows.
    """
    names = schema.names if schema else header_of(spark, path)
    schema = schema or T.StructType([T.StructField(n, T.StringType()) for n in names])
    lines = _lines(spark, path)
    states = materialise(range_states(range_ends(lines)))
    parts = _records(_with_states(lines, states), names)
    whole = parts.where(F.col("_kind") == WHOLE).select("_file", "_start", "_ord", "_text")

    # at most two pieces a range; a record's pieces follow its open one
    order = W.partitionBy("_file").orderBy("_start", "_kind")
    pieces = materialise(parts.where(F.col("_kind") != WHOLE)).withColumn("_g", F.sum((F.col("_kind") == OPEN).cast("long")).over(order))
    in_order = F.array_sort(F.collect_list(F.struct("_start", "_kind", "_text")))
    begun = F.col("_kind") == OPEN
    joined = pieces.groupBy("_file", "_g").agg(
        F.max(F.when(begun, F.col("_start"))).alias("_start"), F.max(F.when(begun, F.col("_ord"))).alias("_ord"),
        F.bool_or("_first").alias("_first"), F.array_join(F.transform(in_order, lambda p: p["_text"]), "\n").alias("_text"),
    )
    records = whole.unionByName(joined.where(~F.col("_first")).select("_file", "_start", "_ord", "_text"))
    options = {"quote": '"', "escape": '"', "multiLine": "true"} | ({"nullValue": NO_TEXT} if keep_empty else {})
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    row = F.concat_ws(":", "_file", F.col("_start").cast("string"), F.col("_ord").cast("string")).alias("_row")
    return records.select(row, F.from_csv("_text", ddl, options).alias("_v")).select("_v.*", "_row")
