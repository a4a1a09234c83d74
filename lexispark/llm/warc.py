"""WARC archives: written as one gzip member a record, and read in byte ranges that any task can take.

A task scans its range for the magic bytes of gzip, and takes a place as a record only if the member decodes to the head of a
WARC record, so bytes inside a member that look alike do no harm. It owns the records that start in its range and reads
the last one beyond its end. Equal payloads of some size are stored once; other records revisit the one that has it.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files

MAGIC = b"\x1f\x8b\x08"
RANGE = 8 << 20
"""Bytes of an archive that a task reads."""
WINDOW = 1 << 20
"""Bytes scanned at once."""
VERSION = b"WARC/1.1"
ANY = b"WARC/"
DATE = "1970-01-01T00:00:00Z"
WRITTEN = "file string, size bigint, records bigint"
RECORDS = "file string, offset bigint, type string, uri string, record string, refers string, digest string, full_length bigint, payload binary"
_RECORDS = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("type", pa.string()), ("uri", pa.string()), ("record", pa.string()), ("refers", pa.string()), ("digest", pa.string()), ("full_length", pa.int64()), ("payload", pa.binary())])


def head(fields: list[tuple[str, str]]) -> bytes:
    """Named fields of a record; line ends in a value would end the field, so they become blanks."""
    lines = [f"{k}: {' '.join(str(v).split())}" for k, v in fields if v is not None]
    return VERSION + b"\r\n" + "".join(x + "\r\n" for x in lines).encode() + b"\r\n"


def record(fields: list[tuple[str, str]], http: bytes, payload: bytes) -> bytes:
    """One gzip member: head, block of HTTP head and payload, two line ends."""
    block = http + payload
    data = head([*fields, ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]) + block + b"\r\n\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields (names in lower case) and payload of a decoded record."""
    top, _, rest = data.partition(b"\r\n\r\n")
    lines = top.split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError("not the head of a WARC record")
    fields = {}
    for line in lines[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
    block = rest[: int(fields["content-length"])]
    if len(block) < int(fields["content-length"]):
        raise ValueError("the block of a record is cut off")
    return fields, block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block


# Writing ------------------------------------------------------------------------------------------


def marked(pages: DataFrame, key: str, html: str, least: int) -> DataFrame:
    """``pages`` with ``_digest`` (SHA-1 of the payload), ``_bytes`` and ``_first``: the id that holds the payload, if another does.

    Only digests travel for this, and a payload that a third of all pages share is counted in each task first.
    """
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    rows = pages.withColumn("_digest", F.sha1(payload.cast("binary"))).withColumn("_bytes", F.octet_length(payload).cast("long"))
    large = rows.where(F.col("_bytes") >= least).groupBy("_digest").agg(F.max(F.col(f"`{key}`")).alias("_holder"), F.count("*").alias("_n")).where("_n > 1")
    joined = rows.join(large.select("_digest", "_holder"), "_digest", "left")
    return joined.withColumn("_first", F.when(F.col("_holder") != F.coalesce(F.col(f"`{key}`"), F.col("_holder") - 1), F.col("_holder"))).drop("_holder")


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", least: int = 1000) -> DataFrame:
    """Writes every page as a record; returns the list of files (stored in ``folder``).

    Of pages with equal payloads of at least ``least`` bytes, the one with the largest id is a response and the others revisit it;
    all smaller ones are responses. A null payload is empty and a null url is left out. Pages with the same, largest id and the
    same payload are all responses; one without an id revisits like any other. Files are named by task and a random suffix, and only those in the list count.
    """
    rows = marked(pages, key, html, least).select(
        F.col(f"`{key}`").cast("long").alias("_0"), F.col(f"`{url}`").cast("string").alias("_1"), F.col(f"`{html}`").cast("string").alias("_2"), "_digest", "_bytes", "_first"
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out, at, n = f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:8]}.warc.gz", None, 0, 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                for row in batch.slice(lo, 64).to_pylist():
                    out = out or files.create(f"{folder}/data/{name}")
                    data = page_record(row)
                    out.write(data)
                    at, n = at + len(data), n + 1
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "size": [at], "records": [n]})

    rows.mapInArrow(write, WRITTEN).write.parquet(f"{folder}/files")
    return pages.sparkSession.read.schema(WRITTEN).parquet(f"{folder}/files")


def page_record(row: dict) -> bytes:
    """The record of a page: a response with its payload, or a revisit with the HTTP head alone."""
    revisit = row["_first"] is not None
    payload = b"" if revisit else (row["_2"] or "").encode()
    digest = "sha1:" + base64.b32encode(bytes.fromhex(row["_digest"])).decode()
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'' if row['_0'] is None else row['_0']}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", row["_1"]),
        ("WARC-Payload-Digest", digest),
        ("X-Payload-Length", str(row["_bytes"])),
    ]
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{row['_first']}>")]
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n".encode()
    return record(fields, http, payload)


# Reading ------------------------------------------------------------------------------------------


def member(f, at: int, size: int) -> tuple[bytes | None, int] | None:
    """The decoded member at a place and where it ends; None if it does not start like a WARC record.

    A member that starts like one and is damaged or cut off (also by the end of a file that is shorter than listed) has no data.
    """
    f.seek(at)
    data = f.read(min(1 << 16, size - at))
    try:
        if zlib.decompressobj(31).decompress(data, len(ANY)) != ANY:
            return None
    except zlib.error:
        return None
    unpack, out, place = zlib.decompressobj(31), [], at
    try:
        while data and not unpack.eof:
            out.append(unpack.decompress(data))
            place += len(data)
            if not unpack.eof:
                f.seek(place)
                data = f.read(max(0, min(WINDOW, size - place)))
    except zlib.error:
        return None, at + 1
    return (b"".join(out), place - len(unpack.unused_data)) if unpack.eof else (None, at + 1)


def records_of(f, size: int, start: int, stop: int) -> Iterator[tuple[int, dict[str, str] | None, bytes]]:
    """Place, fields and payload of every record that starts in a byte range; no fields for a damaged one.

    The search goes on behind a whole member, so what a payload holds is not taken for a record of the archive.
    """
    place = start
    while place < stop:
        f.seek(place)
        # a magic that begins in the range can end beyond it
        data = f.read(min(WINDOW, stop - place) + len(MAGIC) - 1)
        if not data:
            return
        found = data.find(MAGIC)
        if found < 0 or place + found >= stop:
            place += WINDOW
            continue
        at = place + found
        decoded = member(f, at, size)
        place = at + 1
        if decoded is not None:
            whole, place = decoded
            try:
                fields, payload = parse(whole) if whole is not None else (None, b"")
            except (ValueError, KeyError):
                fields, payload = None, b""
            yield at, fields, payload


def read_archives(spark: SparkSession, folder: str, width: int = RANGE) -> DataFrame:
    """All records of the listed files, read in ranges of ``width`` bytes: see ``RECORDS``; ``digest`` is hexadecimal.

    ``full_length`` is the length of the whole payload, which a revisit has too (a field of its own). Records of other tools that lack a field
    have null there. A damaged record has the type ``damaged`` and nothing else. Files in the folder that the list doesn't name are not read.
    """
    listed = spark.read.schema(WRITTEN).parquet(f"{folder}/files")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(width).cast("long"))
    ranges = listed.select("file", "size", F.explode(starts).alias("start"))
    # a task a range: a few bytes stand for all its records, so they must not be merged by size
    ranges = ranges.repartition(max(1, ranges.count()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held, count = [], 0
                with files.opened(f"{folder}/data/{row['file']}") as f:
                    for at, fields, payload in records_of(f, row["size"], row["start"], min(row["start"] + width, row["size"])):
                        held.append(described(row["file"], at, fields, payload))
                        count += len(payload)
                        if count > 2 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema=_RECORDS)
                            held, count = [], 0
                yield pa.RecordBatch.from_pylist(held, schema=_RECORDS)

    return ranges.mapInArrow(read, RECORDS)


def incomplete_files(records: DataFrame, folder: str) -> DataFrame:
    """``file, records, found``: files of the list of which fewer or more records were read than written."""
    listed = records.sparkSession.read.schema(WRITTEN).parquet(f"{folder}/files")
    found = records.where(~F.col("type").eqNullSafe("damaged")).groupBy("file").agg(F.count("*").alias("found"))
    return listed.join(found, "file", "left").select("file", "records", F.coalesce("found", F.lit(0)).alias("found")).where("records <> found")


def described(file: str, at: int, fields: dict[str, str] | None, payload: bytes) -> dict:
    if fields is None:
        return dict.fromkeys(_RECORDS.names) | {"file": file, "offset": at, "type": "damaged"}
    digest = fields.get("warc-payload-digest", "").rpartition(":")[2]
    return {
        "file": file, "offset": at, "type": fields.get("warc-type"), "uri": fields.get("warc-target-uri"),
        "record": fields.get("warc-record-id"), "refers": fields.get("warc-refers-to"),
        "digest": base64.b32decode(digest).hex() if len(digest) == 32 else digest.lower() or None, "full_length": full_length(fields), "payload": payload,
    }


def full_length(fields: dict[str, str]) -> int | None:
    value = fields.get("x-payload-length")
    return int(value) if value and value.isdigit() else None


def archived_pages(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of records that this module wrote.

    A damaged record, or a response whose payload differs from its digest, stops the job: an archive that was damaged is not passed on.
    """

    def page(column: str):
        return F.nullif(F.regexp_extract(column, "<urn:page:(-?[0-9]*)>", 1), F.lit("")).cast("long")

    whole = (F.sha1("payload") == F.col("digest")) & ~F.col("type").eqNullSafe("damaged")
    checked = F.when((F.col("type") == "revisit") | whole, F.col("digest")).otherwise(F.raise_error(F.concat(F.lit("payload differs from its digest: "), F.coalesce("record", F.concat_ws(" ", "file", "offset")))))
    length = F.when(F.col("type") == "revisit", F.col("full_length")).otherwise(F.octet_length("payload").cast("long"))
    return records.select(page("record").alias("page_id"), length.alias("payload_bytes"), checked.alias("payload_digest"), F.col("type").alias("record_type"), page("refers").alias("refers_to"))
