"""Near-duplicate groups by SetSketch registers, bands of them, a joint likelihood estimate, and exact verification.

1. Each text becomes the set of its word shingles' hashes and a sketch: register i keeps the minimum of exponentially
   distributed values, truncated to exponentially spaced levels. Sketches of two sets merge by the maximum register and
   equal a register with probability close to their similarity.
2. Equal sets are one class; only a representative (the smallest id) goes on.
3. ``BAND`` registers together make a bucket key. A pair at similarity 0.8 misses all ``BANDS`` buckets with probability 5e-7.
4. Buckets never emit their pairs. Each representative is first compared with the most often met member of its buckets;
   what links is one group. Members outside the main group of a bucket are then laid against the rest of it in
   blocks of bounded size, in some of the bands first and, with the groups found there, in the others. A block passes on the
   members that may have a partner, is joined with their sets, and returns a spanning forest of the links it confirms.
5. A pair is dropped without its sets only if sizes exclude it or its likelihood estimate is more than five standard
   deviations below the limit. All others are confirmed on the full sets, and only confirmed links join groups.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans as sp
from .common import stored, texts
from .components import components

BAND, BANDS = 6, 48
REGISTERS = BAND * BANDS
BASE, RATE, TOP = 1.1, 20.0, (1 << 8) - 2
"""Spacing of levels, rate of the values, and largest level but one: a register is a byte, and sets of up to 10^9 elements fit."""
EARLY = 8
"""Bands that are searched first; what links there is one group in the others."""
BLOCK = 512
HELD_BYTES, PASSING = 1 << 24, 64
"""Sets of a block that a task holds (one set may be larger), and members that are laid against them at once."""
HELD, PART = 128, 1024
BROADCAST_ROWS = 1_000_000
"""A list of ids is broadcast up to this many rows (8 MB), else joined by shuffle."""
_UNITS = np.array([t for t in range(1, REGISTERS) if np.gcd(t, REGISTERS) == 1], np.int64)
# the k-th smallest of REGISTERS values lies between the k-th and the next of these
_GAMMA = np.concatenate([[0.0], np.log1p(np.arange(1, REGISTERS) / (REGISTERS - np.arange(1, REGISTERS))) / RATE, [np.inf]])


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles of every text, sorted by both."""
    n = len(offsets) - 1
    words = sp.spans(raw, offsets, sp.SPACED, fold=True)
    row, h = sp.windows(words, size, n)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[new], h[new]


def registers(row: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """The registers of ``n`` sets (levels, 0 for an empty set).

    An element gives its k-th smallest value to the k-th register of a permutation of its own; values of a later k
    are larger than all of an earlier one, so a set is done as soon as all its registers are filled.
    """
    best = np.full(n * REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    turn = np.zeros(n * REGISTERS, np.int32)
    first = (sp.mix(h + np.uint64(0xA5)) % np.uint64(REGISTERS)).astype(np.int64)
    step = _UNITS[(sp.mix(h + np.uint64(0x5A)) % np.uint64(len(_UNITS))).astype(np.int64)]
    place = first
    for k in range(1, REGISTERS + 1):
        if not len(row):
            break
        slot = row * REGISTERS + place
        free = (turn[slot] == 0) | (turn[slot] == k)
        slot = slot[free]
        np.minimum.at(best, slot, sp.mix(h[free] + np.uint64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)))
        turn[slot] = k
        open_ = (turn.reshape(n, REGISTERS) == 0).any(axis=1)
        keep = open_[row]
        row, h, step, place = row[keep], h[keep], step[keep], place[keep]
        place = (place + step) % REGISTERS
    filled = turn > 0
    k = turn[filled]
    u = (best[filled].astype(np.float64) + 1) / 2.0**64
    lo, hi = _GAMMA[k - 1], _GAMMA[k]
    value = lo - np.log1p(-np.minimum(u, 1 - 1e-16) * -np.expm1(-RATE * (hi - lo))) / RATE
    level = np.zeros(n * REGISTERS, np.uint8)
    level[filled] = np.clip(np.floor(1 - np.log(value) / np.log(BASE)), 0, TOP + 1)
    return level.reshape(n, REGISTERS)


def band_keys(level: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each sketch."""
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(level), BANDS)).copy()
    parts = level.reshape(-1, BANDS, BAND).astype(np.uint64)
    for i in range(BAND):
        key = sp.mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return key.view(np.int64)


def likely_similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, steps: int = 200) -> np.ndarray:
    """The similarity of most likelihood given how often a register of ``a`` is larger, smaller or equal."""
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    return likeliest(more, less, na, nb, steps)


def likeliest(more: np.ndarray, less: np.ndarray, na: np.ndarray, nb: np.ndarray, steps: int = 200) -> np.ndarray:
    """The same from the counts. ``p(x) = -log_b(1 - x (b - 1) / b)`` is the chance of a larger register."""
    out = np.zeros(len(more))
    for lo in range(0, len(more), 4096):
        part = slice(lo, lo + 4096)
        u = (na[part] / (na[part] + nb[part]))[:, None]
        v = 1 - u
        j = np.linspace(0, 1, steps + 1)[None, :] * np.minimum(u / v, v / u)

        def chance(x: np.ndarray) -> np.ndarray:
            return np.clip(-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE), 1e-12, 1)

        up, down = chance(u - v * j), chance(v - u * j)
        same = np.clip(1 - up - down, 1e-12, 1)
        equal = REGISTERS - more[part] - less[part]
        score = more[part][:, None] * np.log(up) + less[part][:, None] * np.log(down) + equal[:, None] * np.log(same)
        out[part] = j[np.arange(len(j)), score.argmax(axis=1)]
    return out


def floor_of(limit: int) -> float:
    """Estimates below this are five standard deviations under the limit (a percentage)."""
    s = limit / 100
    return s - 5 * np.sqrt(s * (1 - s) / REGISTERS)


# Sketches -----------------------------------------------------------------------------------------

SKETCH = "_id bigint, n bigint, d1 bigint, d2 bigint, sketch binary"
_SKETCH = pa.schema([("_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("sketch", pa.binary())])


def sketches(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """Per row: id, set size, a 128-bit digest of the set and its registers (null for an empty set)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = sp.bytes_of(batch.column("_text"))
            for lo, hi in sp.slices(offsets):
                a, b, n = offsets[lo], offsets[hi], hi - lo
                row, h = shingle_sets(raw[a:b], offsets[lo : hi + 1] - a, size)
                count = sp.counts(row, n)
                d1, d2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
                np.add.at(d1, row, sp.mix(h))
                np.add.at(d2, row, sp.mix(h ^ np.uint64(0xC0FFEE123456789)))
                level = registers(row, h, n)
                packed = [x.tobytes() if c else None for x, c in zip(level, count, strict=True)]
                ids = batch.column("_0").slice(lo, n)
                yield pa.RecordBatch.from_arrays([ids, pa.array(count), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), pa.array(packed, pa.binary())], schema=_SKETCH)

    return texts(docs, key, text=text).withColumn("_0", F.col("_0").cast("long")).mapInArrow(make, SKETCH)


def levels(column: pa.Array) -> np.ndarray:
    raw, _ = sp.bytes_of(column)
    return raw.reshape(-1, REGISTERS)


def bucket_rows(nodes: DataFrame) -> DataFrame:
    """``key, band, node``: every representative in each of its buckets."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = band_keys(levels(batch.column("sketch")))
            ids = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), BANDS)
            yield pa.RecordBatch.from_pydict({"key": found.ravel(), "band": np.tile(np.arange(BANDS, dtype=np.int8), len(found)), "node": ids})

    return nodes.select("node", "sketch").mapInArrow(keys, "key bigint, band tinyint, node bigint")


# Pairs --------------------------------------------------------------------------------------------


def likely(pairs: DataFrame, nodes: DataFrame, limit: int) -> DataFrame:
    """The pairs ``x, y`` that sizes and the likelihood estimate leave over."""
    lowest = floor_of(limit)

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = levels(batch.column("sx")), levels(batch.column("sy"))
            nx, ny = (batch.column(c).to_numpy() for c in ("nx", "ny"))
            good = np.flatnonzero((100 * np.minimum(nx, ny) >= limit * np.maximum(nx, ny)) & (likely_similarity(x, y, nx, ny) >= lowest))
            yield batch.select(["x", "y"]).take(pa.array(good))

    x = nodes.select(F.col("node").alias("x"), F.col("n").alias("nx"), F.col("sketch").alias("sx"))
    y = nodes.select(F.col("node").alias("y"), F.col("n").alias("ny"), F.col("sketch").alias("sy"))
    return pairs.join(x, "x").join(y, "y").select("x", "y", "nx", "ny", "sx", "sy").mapInArrow(estimate, "x bigint, y bigint")


def packed_sets(docs: DataFrame, ids: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """``node, items``: the sorted shingle hashes of the texts with these ids (``node``)."""
    few = ids.count() <= BROADCAST_ROWS
    source = texts(docs, key, text=text).withColumn("_0", F.col("_0").cast("long"))
    listed = ids.select(F.col("node").alias("_0"))
    needed = source.join(F.broadcast(listed) if few else listed, "_0", "left_semi")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = sp.bytes_of(batch.column("_text"))
            for lo, hi in sp.slices(offsets):
                a, b = offsets[lo], offsets[hi]
                row, h = shingle_sets(raw[a:b], offsets[lo : hi + 1] - a, size)
                cut = np.searchsorted(row, np.arange(hi - lo + 1))
                packed = [h[cut[i] : cut[i + 1]].tobytes() for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([batch.column("_0").slice(lo, hi - lo), pa.array(packed, pa.binary())], ["node", "items"])

    return needed.mapInArrow(pack, "node bigint, items binary")


def alike(p: np.ndarray, q: np.ndarray, limit: int) -> bool:
    """Whether two sorted sets have ``100 * intersection >= limit * union``."""
    if 100 * min(len(p), len(q)) < limit * max(len(p), len(q)) or not len(p):
        return False
    at = np.minimum(np.searchsorted(q, p), len(q) - 1)
    both = int((q[at] == p).sum())
    return 100 * both >= limit * (len(p) + len(q) - both)


def block_of(x: Column, blocks: int) -> Column:
    return F.pmod(F.crc32(x.cast("string").cast("binary")), F.lit(blocks)).cast("int")


def blocks_for(held: DataFrame) -> int:
    return max(1, -(-held.count() // HELD))


def verify(candidates: DataFrame, held: DataFrame, blocks: int, docs: DataFrame, key: str, text: str, size: int, limit: int) -> DataFrame:
    """The candidates that link on their full sets, as ``a, b`` (smaller id first).

    ``held`` lists all ``x``, dealt over ``blocks`` (see ``block_of``) of about ``HELD`` sets that a task holds. ``candidates`` has
    ``blk, y, xs``: a node and the nodes of a block that it may link with. The ``y`` of a block stream past it, in parts of about
    ``PART``: a set travels once for each block that it is compared with, not once a pair.
    """
    # at most as many partners as a block has sets
    streams = stored(candidates.groupBy("blk", "y").agg(F.array_distinct(F.flatten(F.collect_list("xs"))).alias("partners")), "streams")
    parts = streams.groupBy("blk").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    still = held.select(block_of(F.col("x"), blocks).alias("blk"), "x").join(parts, "blk").select(
        "blk", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("side"), F.col("x").alias("node"), F.array().cast("array<bigint>").alias("partners")
    )
    passing = streams.join(parts, "blk").select(
        "blk", F.pmod(F.xxhash64("y"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("side"), F.col("y").alias("node"), "partners"
    )
    ids = stored(streams.select(F.col("y").alias("node")).union(held.select("x")).distinct(), "ids")
    rows = still.unionByName(passing).join(packed_sets(docs, ids, key, text, size), "node")
    ordered = rows.repartition("blk", "part").sortWithinPartitions("blk", "part", "side")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sets = None, {}
        for batch in batches:
            items, out = batch.column("items"), []
            columns = [batch.column(c).to_pylist() for c in ("blk", "part", "side", "node", "partners")]
            for i, (blk, part, side, node, partners) in enumerate(zip(*columns, strict=True)):
                if (blk, part) != at:
                    at, sets = (blk, part), {}
                own = np.frombuffer(items[i].as_buffer(), np.uint64)
                if side == 0:  # an id can have several texts
                    sets.setdefault(node, []).append(own.copy())
                else:
                    out += [(min(node, x), max(node, x)) for x in partners if any(alike(own, s, limit) for s in sets[x])]
            yield pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return ordered.select("blk", "part", "side", "node", "partners", "items").mapInArrow(confirm, "a bigint, b bigint").distinct()


def streamed(groups: list[str], work: Callable[[pa.Table], pa.RecordBatch]) -> Callable:
    """For ``mapInArrow`` over sorted partitions: ``work`` gets the whole groups of equal columns, several at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            ids = np.stack([held.column(g).to_numpy() for g in groups])
            same = (ids == ids[:, -1:]).all(axis=0)
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            if cut:
                yield work(held.slice(0, cut))
                held = held.slice(cut).combine_chunks()
        if held is not None and held.num_rows:
            yield work(held)

    return run


def open_buckets(buckets: DataFrame, groups: DataFrame) -> DataFrame:
    """``key, band, node, comp, outside, lefts, rights``: the members of the buckets where more than one group meets.

    ``outside`` is whether a member is not of the bucket's largest group; ``lefts`` and ``rights`` are the blocks for
    those members and for all.
    """
    placed = buckets.join(groups, "node", "left").select("key", "band", "node", F.coalesce("component", "node").alias("comp"))
    sized = placed.groupBy("key", "comp").agg(F.count("*").alias("c"))
    tops = sized.groupBy("key").agg(F.max(F.struct("c", "comp")).alias("top"), F.sum("c").alias("all")).where(F.col("all") > F.col("top.c"))
    blocks = tops.select(
        "key", F.col("top.comp").alias("main"),
        F.ceil((F.col("all") - F.col("top.c")) / BLOCK).cast("int").alias("lefts"), F.ceil(F.col("all") / BLOCK).cast("int").alias("rights"),
    )
    return placed.join(blocks, "key").select("key", "band", "node", "comp", (F.col("comp") != F.col("main")).alias("outside"), "lefts", "rights")


def shared_pairs(left: Members, right: Members, key: int, limit: int) -> tuple[np.ndarray, ...]:
    """Pairs (places in ``left`` and ``right``, registers that are larger, smaller) which a bucket has to settle.

    They are of different groups, their sizes allow a link, ``key`` is the first bucket they share and about enough of their
    registers are equal. A pair that could be met from both of its ends is taken from the smaller id.
    """
    x, y = np.repeat(np.arange(len(left.node)), len(right.node)), np.tile(np.arange(len(right.node)), len(left.node))
    nx, ny = left.n[x], right.n[y]
    good = (left.comp[x] != right.comp[y]) & (100 * np.minimum(nx, ny) >= limit * np.maximum(nx, ny))
    good &= ~right.outside[y] | (left.node[x] < right.node[y])
    x, y = x[good], y[good]
    more, less, first = (np.zeros(len(x), np.int64) for _ in range(3))
    for s in range(0, len(x), 8192):
        part = slice(s, s + 8192)
        u, v = x[part], y[part]
        more[part] = (left.level[u] > right.level[v]).sum(axis=1)
        less[part] = (left.level[u] < right.level[v]).sum(axis=1)
        shared = left.bands[u] == right.bands[v]
        first[part] = np.where(shared.any(axis=1), left.bands[u, shared.argmax(axis=1)], ~key)
    # an estimate at the limit needs about that share of equal registers
    good = (first == key) & (REGISTERS - more - less >= (floor_of(limit) - 0.05) * REGISTERS)
    return x[good], y[good], more[good], less[good]


class Members:
    """Some members of a bucket as arrays: ids, groups, set sizes, registers, bucket keys, and whether outside the largest group."""

    def __init__(self, t: pa.Table | pa.RecordBatch):
        self.node, self.comp, self.n, self.outside = (t.column(c).to_numpy(zero_copy_only=False) for c in ("node", "comp", "n", "outside"))
        self.level = levels(t.column("sketch"))
        self.bands = band_keys(self.level)

    def __getitem__(self, at: slice | np.ndarray) -> Members:
        out = object.__new__(Members)
        out.__dict__ = {k: v[at] for k, v in self.__dict__.items()}
        return out


_MEMBERS = "key bigint, i int, j int, part int, side int, node bigint, comp bigint, n bigint, outside boolean, sketch binary"


def block_members(rows: DataFrame, nodes: DataFrame, limit: int) -> DataFrame:
    """The members of open buckets (``rows`` of ``open_buckets``) that a partner may be found for, by block.

    The members outside a bucket's largest group (side 0) are cut into blocks of about ``BLOCK`` and laid against all members
    (side 1) in such blocks. At most one row comes out of a member in a block, and no pair; if the sets of side 0 are
    larger than ``HELD_BYTES`` together, the block is split into ``part``s and side 1 is repeated for each that needs it.
    """
    left = rows.where("outside").select(
        "key", F.pmod(F.xxhash64("node"), F.col("lefts")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("rights") - 1)).alias("j"),
        F.lit(0).alias("side"), "node", "comp", "outside",
    )
    right = rows.select(
        "key", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)).alias("i"), F.pmod(F.xxhash64("node", F.lit(7)), F.col("rights")).cast("int").alias("j"),
        F.lit(1).alias("side"), "node", "comp", "outside",
    )
    drawn = left.unionByName(right).join(nodes.select("node", "n", "sketch"), "node")
    dealt = drawn.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side")

    def work(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        key, i, j, side = (t.column(c).to_numpy() for c in ("key", "i", "j", "side"))
        every = Members(t)
        change = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
        rows_out, parts_out = [], []
        for lo, hi in zip(np.append(0, change).tolist(), np.append(change, len(key)).tolist(), strict=True):
            split = lo + int((side[lo:hi] == 0).sum())
            x, y, _, _ = shared_pairs(every[lo:split], every[split:hi], key[lo], limit)
            if not len(x):
                continue
            held = np.unique(x)
            size = 8 * every.n[lo + held]
            part = np.zeros(split - lo, np.int64)
            part[held] = (np.cumsum(size) - size) // HELD_BYTES
            met = np.unique(np.stack([part[x], y]), axis=1)
            rows_out += [lo + held, split + met[1]]
            parts_out += [part[held], met[0]]
        at = np.concatenate(rows_out) if rows_out else np.zeros(0, np.int64)
        parts = np.concatenate(parts_out) if parts_out else np.zeros(0, np.int64)
        columns = {name: t.column(name).take(pa.array(at)).combine_chunks() for name in t.column_names}
        columns["part"] = pa.array(parts.astype(np.int32))
        return pa.RecordBatch.from_pydict({c.split()[0]: columns[c.split()[0]] for c in _MEMBERS.split(", ")})

    return dealt.select("key", "i", "j", "side", "node", "comp", "n", "outside", "sketch").mapInArrow(streamed(["key", "i", "j"], work), _MEMBERS)


class Forest:
    """Groups that links join; ``join`` says whether two were apart."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, g: int) -> int:
        while (parent := self.up.get(g, g)) != g:
            self.up[g] = g = self.up.get(parent, parent)
        return g

    def join(self, g: int, h: int) -> bool:
        g, h = self.root(g), self.root(h)
        self.up[max(g, h)] = min(g, h)
        return g != h


def block_links(members: DataFrame, docs: DataFrame, key: str, text: str, size: int, limit: int) -> DataFrame:
    """Links ``a, b`` that join all groups which members of one block (rows of ``block_members``) link on their full sets.

    Side 0 of a part of a block is held, side 1 streams past it. A pair is compared unless sizes or its estimate exclude it or
    confirmed links of the part join its groups already; so a part returns a spanning forest, fewer links than it has members.
    """
    sets = packed_sets(docs, members.select("node").distinct(), key, text, size)
    group = ["key", "i", "j", "part"]
    ordered = members.join(sets, "node").repartition(*group).sortWithinPartitions(*group, "side")
    lowest = floor_of(limit)

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, forest, held, held_sets = None, Forest(), [], []
        for batch in batches:
            ids = np.stack([batch.column(c).to_numpy() for c in (*group, "side")]) if batch.num_rows else np.zeros((5, 0), np.int64)
            cuts = (np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1).tolist()
            links = []
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True) if batch.num_rows else ():
                if tuple(ids[:4, lo]) != at:
                    at, forest, held, held_sets = tuple(ids[:4, lo]), Forest(), [], []
                run = batch.slice(lo, hi - lo)
                own = [np.frombuffer(v.as_buffer(), np.uint64) for v in run.column("items")]
                if ids[4, lo] == 0:
                    held.append(run.select(["node", "comp", "n", "outside", "sketch"]))
                    held_sets += [v.copy() for v in own]
                    continue
                left, right = Members(pa.Table.from_batches(held).combine_chunks()), Members(run)
                for s in range(0, hi - lo, PASSING):
                    some = right[s : s + PASSING]
                    x, y, more, less = shared_pairs(left, some, int(ids[0, lo]), limit)
                    score = likeliest(more, less, left.n[x], some.n[y])
                    order = np.argsort(-score, kind="stable")
                    order = order[score[order] >= lowest]
                    for u, v in zip(x[order].tolist(), y[order].tolist(), strict=True):
                        g, h = int(left.comp[u]), int(some.comp[v])
                        if forest.root(g) != forest.root(h) and alike(held_sets[u], own[s + v], limit):
                            forest.join(g, h)
                            links.append(sorted((int(left.node[u]), int(some.node[v]))))
            yield pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return ordered.select(*group, "side", "node", "comp", "n", "outside", "sketch", "items").mapInArrow(confirm, "a bigint, b bigint").distinct()


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 2, limit: int = 80) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id`` (smallest id reachable) and ``kept`` (it is its own component).

    Words are runs without white space of ASCII, A-Z counts as a-z, and a text of fewer than ``size`` words has one shingle of them
    all. Null and empty texts have no shingles and no link. Rows that share an id are one document with several texts; a row
    without an id links with nothing, has a null component and is kept. An empty table gives an empty result.
    """
    rows = stored(sketches(docs, key, text, size), "sketches")
    named = rows.where("_id IS NOT NULL AND n > 0")
    classes = named.groupBy("d1", "d2").agg(F.min("_id").alias("node"))
    nodes = stored(
        named.join(classes, ["d1", "d2"]).where("_id = node").select("node", "n", "sketch", "d1", "d2").dropDuplicates(["node", "d1", "d2"]), "nodes"
    )
    every = bucket_rows(nodes)
    shared = every.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    buckets = stored(every.join(shared, "key").select("key", "band", "node", "c"), "buckets")

    # one partner for each: the member met most often among those of its buckets
    met = buckets.groupBy("node").agg(F.sum("c").alias("met"))
    hubs = buckets.join(met, "node").groupBy("key").agg(F.max(F.struct("met", -F.col("node"))).alias("hub"))
    chosen = buckets.join(hubs, "key").groupBy("node").agg(F.max("hub").alias("hub")).select("node", (-F.col("hub.col2")).alias("hub"))
    first = chosen.where("node <> hub").select(F.col("hub").alias("x"), F.col("node").alias("y"))
    pairs = stored(likely(first, nodes, limit), "pairs")
    hubs = pairs.select("x").distinct()
    blocks = blocks_for(hubs)
    placed = pairs.select(block_of(F.col("x"), blocks).alias("blk"), "y", F.array("x").alias("xs"))
    links = stored(verify(placed, hubs, blocks, docs, key, text, size, limit), "links")
    groups = components(links)

    one = nodes.dropDuplicates(["node"])
    early = F.col("band") < EARLY
    for bands in (early, ~early):  # a pair is settled in the first bucket it shares, so no pair is met in both
        open_ = stored(open_buckets(buckets.where(bands), groups), "open")
        members = stored(block_members(open_, one, limit), "members")
        if not members.isEmpty():
            more = stored(block_links(members, docs, key, text, size, limit), "links")
            if not more.isEmpty():
                links = stored(links.unionByName(more), "links")
                groups = components(links)

    # texts with the same id are one document
    twice = named.join(classes, ["d1", "d2"]).select("_id", F.col("node")).where("_id <> node")
    repeated = named.groupBy("_id").agg(F.count("*").alias("c")).where("c > 1").select("_id")
    same_id = twice.join(repeated, "_id").select(F.col("_id").alias("a"), F.col("node").alias("b"))
    if not same_id.isEmpty():
        groups = components(stored(links.unionByName(same_id), "links"))

    placed = named.select("_id", "n", "d1", "d2").join(classes, ["d1", "d2"]).join(groups, "node", "left")
    placed = placed.select("_id", F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("component_id"))
    alone = rows.where("_id IS NULL OR n = 0").select("_id", F.col("n").alias("n_shingles"), F.col("_id").alias("component_id"))
    out = placed.unionByName(alone)
    kept = F.coalesce(F.col("_id") == F.col("component_id"), F.lit(True))
    return out.select(F.col("_id").alias(key), "n_shingles", "component_id", kept.alias("kept"))
