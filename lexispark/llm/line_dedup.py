"""Line deduplication over a whole corpus with DataFrame functions only.

Lines become 96-bit hashes with their document and position; the text itself stays where it is. The hashes are
range-partitioned together with a piece of the documents, so a line that a third of all documents hold is cut over many ranges,
and sorted by document and position inside a range. Each range streams the first occurrences and sums its part of a key up in one
row (documents, last document), and only those rows meet. What returns to the documents is a keep bitmap in runs, never text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, unused

BLANKS = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_lines(text: Column) -> Column:
    """The lines of a text; null and empty have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """A line without outer white space and with A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, UPPER.lower())


def row_key(key: str, text: str) -> list[Column]:
    """What tells a row from others: its id, and hashes of the text in case an id is repeated.

    Rows alike in both have the same lines, hence the same bitmap.
    """
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return [F.col(f"`{key}`").alias("_id"), F.xxhash64(t).alias("_x"), F.hash(t).alias("_y")]


def line_hashes(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 40) -> DataFrame:
    """One row for each line whose key has at least ``min_chars`` code points: hash, document, position."""
    at = docs.select(*row_key(key, text), F.posexplode(text_lines(F.col(f"`{text}`"))).alias("_pos", "_line"))
    keyed = at.where(F.length("_line") >= min_chars).withColumn("_key", line_key(F.col("_line"))).where(F.length("_key") >= min_chars)
    return keyed.select(F.xxhash64("_key").alias("_h"), F.hash("_key").alias("_g"), "_id", "_x", "_y", "_pos")


def first_occurrences(lines: DataFrame) -> DataFrame:
    """The lines (see ``line_hashes``) as ``_h, _g, _id`` and ``_first``: whether a line is the first of its key in its document.

    Keys are range-partitioned with a piece of the documents, as many pieces as the shuffle has partitions, so a key that most
    documents hold lies in many ranges. Inside a range lines stream in the order of key, piece, document and position.
    """
    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = lines.select("_h", "_g", F.pmod(F.hash("_id"), F.lit(tasks)).alias("_s"), "_id", "_pos")
    stream = Window.partitionBy("_h", "_g", "_s").orderBy("_id", "_pos")
    again = (F.row_number().over(stream) > 1) & F.lag("_id").over(stream).eqNullSafe(F.col("_id"))
    return placed.repartitionByRange("_h", "_g", "_s").select("_h", "_g", "_id", (~again).alias("_first"))


def lost_lines(lines: DataFrame, common: DataFrame) -> DataFrame:
    """The lines of the keys in ``common`` that lie outside the key's last document.

    Keys with a partition's share of all lines or more are fewer than the partitions, so they are broadcast and their lines stay
    where they are; the others meet their lines by shuffle.
    """
    limit = max(1.0, lines.count() / int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keys = common.select("_h", "_g", "_last", (F.col("rows") >= limit).alias("hot"))
    hot = F.broadcast(keys.where("hot").drop("hot"))
    cold = lines.join(hot.drop("_last"), ["_h", "_g"], "left_anti").join(keys.where("NOT hot").drop("hot"), ["_h", "_g"])
    return lines.join(hot, ["_h", "_g"]).unionByName(cold).where(~F.col("_id").eqNullSafe(F.col("_last")))


def keep_bitmaps(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The documents that lose lines: ``_id, _x, _y`` (see ``row_key``) and ``dropped``, sorted runs ``(first, last)``.

    A key found in at least ``min_docs`` documents stays in the one with the largest id only, where all its lines stay.
    Rows with the same id, or with none, count as one document, and a null id is smaller than any. Documents without a
    row keep every line. An empty table gives an empty result.
    """
    lines = stored(line_hashes(docs, key, text, min_chars), "lines")
    held = first_occurrences(lines).groupBy("_h", "_g").agg(F.count_if("_first").alias("docs"), F.count("*").alias("rows"), F.max("_id").alias("_last"))
    lost = lost_lines(lines, stored(held.where(F.col("docs") >= min_docs), "common"))
    places = F.array_sort(F.collect_list("_pos"))
    rows = lost.groupBy("_id", "_x", "_y").agg(F.array_distinct(places).alias("_at"))
    first = F.expr("filter(_at, (p, i) -> i = 0 OR _at[i - 1] <> p - 1)")
    last = F.expr("filter(_at, (p, i) -> i = size(_at) - 1 OR _at[i + 1] <> p + 1)")
    return rows.select("_id", "_x", "_y", F.arrays_zip(first.alias("first"), last.alias("last")).alias("dropped"))


def kept_runs(dropped: Column, n: Column) -> Column:
    """The complement of the dropped runs within ``n`` lines: where each kept run starts, and its length."""
    starts = F.concat(F.array(F.lit(0)), F.transform(dropped, lambda r: r["last"] + 1))
    ends = F.concat(F.transform(dropped, lambda r: r["first"]), F.array(n))
    runs = F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), (b - a).alias("length")))
    return F.filter(runs, lambda r: r["length"] > 0)


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped``, ``keep_runs`` (the bitmap) and ``kept_text``; see ``keep_bitmaps``.

    Columns of these names, in capitals or not, are replaced; no other name matters.
    """
    own = unused(docs, "_row")
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped", "keep_runs", "kept_text")]
    bitmaps = keep_bitmaps(docs, key, text, min_chars, min_docs).select(F.struct("_id", "_x", "_y").alias(f"{own}_b"), F.col("dropped").alias(f"{own}_d"))
    whole = [] if text in names else [F.col(f"`{text}`").alias(f"{own}_t")]
    keyed = docs.select(*[F.col(f"`{c}`") for c in names], *whole, F.struct(*row_key(key, text)).alias(own))
    same = F.col(f"{own}._id").eqNullSafe(F.col(f"{own}_b._id"))
    for c in ("_x", "_y"):
        same &= F.col(f"{own}.{c}") == F.col(f"{own}_b.{c}")
    held = F.coalesce(F.col(f"{own}_t" if whole else f"`{text}`"), F.lit(""))
    lines, dropped = F.col(f"{own}_l"), F.col(f"{own}_d")
    n = F.size(lines)
    none = F.array(F.struct(F.lit(0).alias("start"), n.alias("length")))
    joined = keyed.join(bitmaps, same, "left").withColumn(f"{own}_l", text_lines(held))
    joined = joined.withColumn(f"{own}_r", F.when(dropped.isNull(), none).otherwise(kept_runs(dropped, n)))
    runs = F.col(f"{own}_r")
    parts = F.flatten(F.transform(runs, lambda r: F.slice(lines, r["start"] + 1, r["length"])))
    kept = F.when(dropped.isNull(), held).otherwise(F.array_join(parts, "\n"))
    n_kept = F.aggregate(runs, F.lit(0), lambda acc, r: acc + r["length"])
    return joined.select(
        *[F.col(f"`{c}`") for c in names],
        n.cast("long").alias("n_lines"),
        (n - n_kept).cast("long").alias("n_dropped"),
        runs.alias("keep_runs"),
        kept.alias("kept_text"),
    )
