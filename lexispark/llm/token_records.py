"""Token ids as length-delimited binary records, with a separate table of offsets for shuffled reads.

A record is ``length (u64) | masked CRC-32 of those 8 bytes (u32) | payload | masked CRC-32 of the payload (u32)``, little
endian throughout. The payload is one sequence: ``document id (i64) | 1 if it has one (u8) | bytes of an id (u8) | ids``.
A checksum is masked so that a record that itself holds records has no checksum over checksums.
The checksum is zlib's, the one that Python has natively. Files are named by the task that wrote them and a random suffix, and only the
files that the offset table names count: an attempt that was lost leaves nothing that is read.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import files
from . import spans as sp
from .common import texts
from .pieces import PieceCache, hash_ranges

SLICE = 1 << 20
HEAD = struct.Struct("<QI")
PAYLOAD = struct.Struct("<qBB")
OFFSETS = "part int, file string, doc_id bigint, offset bigint, n_tokens bigint"
_OFFSETS = pa.schema([("part", pa.int32()), ("file", pa.string()), ("doc_id", pa.int64()), ("offset", pa.int64()), ("n_tokens", pa.int64())])
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0


def masked(data: bytes) -> int:
    """The checksum rotated by 15 bits plus a constant."""
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def unframed(f) -> bytes | None:
    """The payload of the record at the file's place, None at its end."""
    head = f.read(HEAD.size)
    if not head:
        return None
    if len(head) < HEAD.size:
        raise ValueError("a record is cut off in its head")
    length, check = HEAD.unpack(head)
    if masked(head[:8]) != check:
        raise ValueError("the checksum of a length is wrong")
    body = f.read(length + 4)
    if len(body) < length + 4:
        raise ValueError("a record is cut off in its payload")
    if masked(body[:length]) != struct.unpack("<I", body[length:])[0]:
        raise ValueError("the checksum of a payload is wrong")
    return body[:length]


# Encoding -----------------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Letter, number, white space or other for every code point."""
    text = "".join(chr(i) if not 0xD800 <= i < 0xE000 else "\0" for i in range(0x110000))
    out = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, text):
            out[m.start() : m.end()] = kind
    return out


def pretoken_starts(cp: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where the byte-level pre-tokens begin: code points of many texts, ``edges`` their starts and the end.

    Runs of letters, numbers or others take one blank before them; white space before a text's next run gives it its last
    character (kept apart unless it is that blank); ``'s 't 're 've 'm 'll 'd`` part from a run of letters or numbers.
    """
    n = len(cp)
    kind = classes()[cp]
    edge = np.zeros(n + 1, bool)
    edge[edges] = True
    start = np.ones(n, bool)
    start[1:] = kind[1:] != kind[:-1]
    start |= edge[:-1]
    space = kind == SPACE
    # the last white space of a run that does not end its text
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~edge[1:-1])
    blank = cp[last] == 32
    start[last] = True
    start[last[blank] + 1] = False
    quote = np.flatnonzero((cp[:-1] == 39) & start[:-1] & (kind[1:] == LETTER) & ~edge[1:-1])
    if len(quote):
        rest = np.full((len(quote), 2), 0, np.int64)
        rest[:, 0] = cp[quote + 1]
        two = np.flatnonzero((quote + 2 < n) & ~edge[np.minimum(quote + 2, n)])
        rest[two, 1] = cp[quote[two] + 2]
        size = np.zeros(len(quote), np.int64)
        for pair in ("re", "ve", "ll"):
            size[(rest[:, 0] == ord(pair[0])) & (rest[:, 1] == ord(pair[1]))] = 2
        size[np.isin(rest[:, 0], [ord(c) for c in "stmd"])] = 1
        quote, size = quote[size > 0], size[size > 0]
        start[quote + 1] = False
        after = quote + 1 + size
        start[after[after < n]] = True
    return np.flatnonzero(start)


@lru_cache(maxsize=1)
def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class ByteEncoder:
    """Ids of texts by a byte-level BPE file of the ``tokenizers`` library.

    The file's pre-tokens are cut for many texts at once, and the library's model encodes every distinct one once
    (invented or rare words keep the library's own small cache from helping). As in the library, the strings of the file's added
    tokens are cut out of a text first and have one id each; with ``encode_special_tokens`` those of special ones are ordinary text.
    """

    def __init__(self, path: str, encode_special_tokens: bool = True):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        self.model = library.model
        self.cache = PieceCache()
        added = {i: t for i, t in library.get_added_tokens_decoder().items() if t.content and not (t.special and encode_special_tokens)}
        for t in added.values():
            if t.lstrip or t.rstrip or t.single_word or (t.normalized and library.normalizer is not None):
                raise ValueError(f"added token {t.content!r}: lstrip, rstrip, single_word and normalized are not supported")
        self.added = {t.content.encode(): i for i, t in added.items()}
        # the longest of those that begin at a place
        self.pattern = re.compile(b"|".join(re.escape(x) for x in sorted(self.added, key=len, reverse=True))) if self.added else None

    def cut_out(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Byte ranges of added tokens, none across two texts."""
        data = raw.tobytes()
        if self.pattern is None or not any(x in data for x in self.added):
            return np.zeros((0, 2), np.int64)
        found = [(a + m.start(), a + m.end()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True) for m in self.pattern.finditer(data[a:b])]
        return np.array(found, np.int64).reshape(-1, 2)

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and the number of ids of each."""
        n = len(offsets) - 1
        if not len(raw):
            return np.zeros(0, np.int32), np.zeros(n, np.int64)
        cp = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        edges = before[offsets]
        whole = before[self.cut_out(raw, offsets)]
        start = pretoken_starts(cp, np.union1d(edges, whole))
        for_one = np.searchsorted(start, whole)
        inner = np.zeros(len(start) + 1, np.int64)
        np.add.at(inner, for_one[:, 0] + 1, 1)
        np.add.at(inner, for_one[:, 1], -1)
        start = start[np.cumsum(inner)[:-1] == 0]
        end = np.append(start[1:], len(cp))
        letters = byte_letters()

        def new(places: np.ndarray) -> list[list[int]]:
            out = []
            for p in places:
                data = cp[start[p] : end[p]].tobytes().decode("utf-32-le").encode()
                out.append([self.added[data]] if data in self.added else [t.id for t in self.model.tokenize(data.decode("latin-1").translate(letters))])
            return out

        ids, length = self.cache.encode(hash_ranges(cp, start, end), new)
        row = np.searchsorted(edges, start, "right") - 1
        return ids, np.bincount(row, length, minlength=n).astype(np.int64)


@lru_cache(maxsize=2)
def byte_encoder(path: str) -> ByteEncoder:
    """One encoder a worker process, with the library's default settings; the path is that of an installed file."""
    return ByteEncoder(path, encode_special_tokens=False)


def vocabulary_of(path: str) -> int:
    """One more than the largest id of a tokenizer file."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values(), default=-1) + 1


# Writing and reading ------------------------------------------------------------------------------


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int, vocabulary: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes every text's ids and ``end_id`` in ascending order of the key; returns the offset table (stored in ``folder``).

    The ids are those of the library's ``encode`` without ``add_special_tokens``: the string of an added token is its one id.
    Null texts are empty, so only ``end_id`` is written. Rows without an id come first, rows with the same id are in order of
    their text's hash. Ids take two bytes if the vocabulary (without one: the tokenizer file and ``end_id``) has at most
    65,536 entries, else four; an id beyond its bytes is an error. An empty table writes an empty offset table.
    """
    if vocabulary is None:
        vocabulary = max(vocabulary_of(tokenizer), end_id + 1)
    width = 2 if vocabulary <= 1 << 16 else 4
    top = (1 << 8 * width) - 1
    if not 0 <= end_id <= top:
        raise ValueError(f"end_id {end_id} does not fit into {width} bytes")
    # rows alike in id and text are dealt over ranges too
    ordered = texts(docs, key, text=text).withColumns({"_0": F.col("_0").cast("long"), "_h": F.xxhash64("_text"), "_k": F.monotonically_increasing_id()})
    ordered = ordered.repartitionByRange("_0", "_h", "_k").sortWithinPartitions("_0", "_h", "_k").select("_0", "_text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder = TaskContext.get().partitionId(), byte_encoder(tokenizer)
        name, out, at = f"tokens-{part:06d}-{uuid.uuid4().hex[:8]}.bin", None, 0
        for batch in batches:
            raw, offsets = sp.bytes_of(batch.column("_text"))
            keys = batch.column("_0").to_pylist()
            for lo, hi in sp.slices(offsets, SLICE):
                a, b = offsets[lo], offsets[hi]
                ids, count = encoder.encode(raw[a:b], offsets[lo : hi + 1] - a)
                if len(ids) and ids.max() > top:
                    raise ValueError(f"id {ids.max()} does not fit into {width} bytes: the vocabulary given is too small")
                cut = np.concatenate([[0], np.cumsum(count)])
                packed = ids.astype(f"<u{width}")
                places, tail = [], np.array([end_id], f"<u{width}").tobytes()
                out = out or files.create(f"{folder}/data/{name}")
                for i in range(hi - lo):
                    record = framed(payload_of(keys[lo + i], width, packed[cut[i] : cut[i + 1]].tobytes() + tail))
                    out.write(record)
                    places.append(at)
                    at += len(record)
                n = hi - lo
                yield pa.RecordBatch.from_pydict({"part": [part] * n, "file": [name] * n, "doc_id": keys[lo:hi], "offset": places, "n_tokens": count + 1}, schema=_OFFSETS)
        if out:
            out.close()

    ordered.mapInArrow(write, OFFSETS).write.parquet(f"{folder}/offsets")
    return docs.sparkSession.read.schema(OFFSETS).parquet(f"{folder}/offsets")


def payload_of(key: int | None, width: int, ids: bytes) -> bytes:
    return PAYLOAD.pack(key or 0, key is not None, width) + ids


def parsed(payload: bytes) -> tuple[int | None, np.ndarray]:
    """Document id and ids of a record."""
    key, has, width = PAYLOAD.unpack_from(payload)
    return key if has else None, np.frombuffer(payload, f"<u{width}", offset=PAYLOAD.size)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """All records in sequence: ``part, doc_id, start, ids``; ``start`` counts the ids of all records before."""
    offsets = spark.read.schema(OFFSETS).parquet(f"{folder}/offsets")
    # one row a file
    sizes = offsets.groupBy("part", "file").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    listed = sizes.select("part", "file", F.coalesce(before, F.lit(0)).alias("before"))
    schema = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, starts, ids, at, held = [], [], [], row["before"], 0
                with files.opened(f"{folder}/data/{row['file']}") as raw:
                    f = pa.BufferedInputStream(raw, 1 << 20)
                    while (payload := unframed(f)) is not None:
                        key, found = parsed(payload)
                        keys.append(key), starts.append(at), ids.append(found.astype(np.int32))
                        at += len(found)
                        held += len(found)
                        if held > 1 << 19:
                            yield _batch(row["part"], keys, starts, ids, schema)
                            keys, starts, ids, held = [], [], [], 0
                yield _batch(row["part"], keys, starts, ids, schema)

    # a task a file: a few bytes of names stand for all its records, so they must not be merged by size
    spread = listed.repartition(max(1, sizes.count()))
    return spread.mapInArrow(read, "part int, doc_id bigint, start bigint, ids array<int>")


def _batch(part: int, keys: list, starts: list, ids: list, schema: pa.Schema) -> pa.RecordBatch:
    edges = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return pa.RecordBatch.from_arrays([pa.array([part] * len(keys), pa.int32()), pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), pa.ListArray.from_arrays(pa.array(edges), pa.array(flat))], schema=schema)


def read_at(folder: str, file: str, offset: int) -> tuple[int | None, np.ndarray]:
    """One record by its place in the offset table, for reads in any order."""
    with files.opened(f"{folder}/data/{file}") as f:
        f.seek(offset)
        return parsed(unframed(f))


def shuffled_reads(offsets: DataFrame, folder: str, seed: int) -> DataFrame:
    """``doc_id, ids`` of all records in a random order of the whole corpus, read by offset."""
    dealt = offsets.withColumn("_r", F.xxhash64(F.lit(seed), "file", "offset"))
    dealt = dealt.repartitionByRange("_r").sortWithinPartitions("_r").select("file", "offset")
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows = [read_at(folder, r["file"], r["offset"]) for r in batch.slice(lo, 256).to_pylist()]
                yield pa.RecordBatch.from_pydict({"doc_id": [k for k, _ in rows], "ids": [x.astype(np.int32) for _, x in rows]}, schema=schema)

    return dealt.mapInArrow(read, "doc_id bigint, ids array<int>")


def sequence_digests(records: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32``: the CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            edges, flat = ids.offsets.to_numpy(), ids.values.to_numpy().astype("<u4")
            codes = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(np.diff(edges).astype(np.int64)), pa.array(codes, pa.int64())], schema=schema)

    return records.mapInArrow(digest, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
