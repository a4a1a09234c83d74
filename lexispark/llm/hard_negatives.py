"""Hard negatives by exact inner-product search over lists that a cluster of anchors shares.

Anchors are clustered by direction. For a cluster with centre c whose members lie within the angle b of it, no member of length 1 has an inner
product above ``|v| cos(max(0, angle(v, c) - b))`` with a candidate v. That bound orders the cluster's list once; every member walks it until its
length times the bound falls below what it still looks for, which certifies that nothing behind can count. What a member looks for:

1. positives: its k best candidates of the same label, first in the head of the list, then, with the k-th best known, in the rest;
2. negatives: for each positive the k best candidates of other labels whose score lies in a window below the positive's.

A list's entries are blocks of candidates of like bound. It is never one piece: blocks are dealt over pieces by hash, each of which is sorted and walked by
itself, and many members of a cluster are dealt over chunks. Candidates whose bound is below what any member of a cluster needs are not sent there at all. Scores are exact integers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

CLUSTERS = (4, 16, 64)
"""Numbers of clusters, of which the one is taken that is likely to send the fewest candidates to lists."""
SAMPLE = 4096
"""Anchors that the centres are fitted on, and candidates that say where a list's head ends; neither changes a result."""
HEAD = 1 / 32
"""Share of a list that is its head."""
CHUNK, PIECE, LEAST = 16_384, 131_072, 4096
"""Members, and candidates, that a task has of one cluster (about), and the fewest candidates worth a task."""
TASKS = 20_000
BLOCK, CELLS = 512, 1 << 21
"""Candidates of like bound that travel and are scored together, and scores held at once."""
NONE, LOW, HIGH = np.iinfo(np.int64).max, -(1 << 62), 1 << 62
"""Id of a row without one, and the bounds of a window without one."""
SLACK = 1e-6
"""Relative allowance for the rounding of angles."""


def usable(rows: DataFrame, anchors: Column, key: str, vector: str, label: str) -> DataFrame:
    """``id, label, v, anchor``: the rows with a label and a vector of finite numbers."""
    is_anchor = F.coalesce(anchors & F.col(f"`{key}`").isNotNull(), F.lit(False))
    named = rows.select(
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(int(NONE))).alias("id"), F.col(f"`{label}`").cast("long").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("v"), is_anchor.alias("anchor"),
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return named.where(F.col("label").isNotNull() & F.col("v").isNotNull() & finite)


class Shape:
    """Width of the vectors and the types that hold components and scores exactly."""

    def __init__(self, dim: int, most: float, norm2: float):
        self.dim = dim
        self.packed = np.dtype("<i2" if most <= 32767 else "<f8")
        # sums of products are at most the largest squared length
        self.kind = np.float32 if norm2 < 1 << 24 else np.float64 if norm2 < 1 << 53 else object

    def pack(self, column: pa.ListArray) -> list[bytes]:
        edges = column.offsets.to_numpy()
        flat = column.values.to_numpy()
        return [np.pad(flat[a:b], (0, self.dim - (b - a))).astype(self.packed).tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def matrix(self, packed: pa.Array | bytes) -> np.ndarray:
        """The vectors of a column, or of a block, as doubles."""
        raw = packed if isinstance(packed, bytes) else b"".join(packed.to_pylist())
        return np.frombuffer(raw, self.packed).reshape(-1, self.dim).astype(np.float64)

    def scored(self, m: np.ndarray) -> np.ndarray:
        """The same for products; whole numbers of any size if no float holds them."""
        return m.astype(self.kind) if self.kind is not object else np.array([[int(x) for x in r] for r in m.tolist()], object).reshape(m.shape)


def packed_rows(rows: DataFrame, shape: Shape) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array(shape.pack(b.column("v")), pa.binary()), b.column("anchor")], ["id", "label", "vec", "anchor"])

    return rows.mapInArrow(run, "id bigint, label bigint, vec binary, anchor boolean")


# Clusters and bounds ------------------------------------------------------------------------------


def unit(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norm = np.sqrt((m * m).sum(axis=1))
    return m / np.where(norm > 0, norm, 1)[:, None], norm


def centres(sample: np.ndarray, clusters: int, rounds: int = 10) -> np.ndarray:
    """Unit centres by spherical k-means, begun with vectors far from each other."""
    points = np.unique(unit(sample)[0], axis=0)
    points = points[(points != 0).any(axis=1)]
    if not len(points):
        return np.eye(1, sample.shape[1])
    chosen = [int((points @ points.mean(axis=0)).argmax())]
    near = points @ points[chosen[0]]
    while len(chosen) < min(clusters, len(points)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, points @ points[chosen[-1]])
    c = points[chosen]
    for _ in range(rounds):
        of = (points @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, of, points)
        c = np.where((sums != 0).any(axis=1)[:, None], unit(sums)[0], c)
    return c


def angles(m: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angles between vectors and centres (0 for a vector without length), and lengths."""
    u, norm = unit(m)
    return np.where(norm[:, None] > 0, np.arccos(np.clip(u @ c.T, -1, 1)), 0), norm


def bounds(m: np.ndarray, c: np.ndarray, widest: np.ndarray) -> np.ndarray:
    """For each vector and cluster what no product with a member of length 1 exceeds."""
    angle, norm = angles(m, c)
    return norm[:, None] * (np.cos(np.maximum(0, angle - widest[None, :])) + SLACK)


def grouped(anchors: np.ndarray, candidates: np.ndarray, numbers: tuple[int, ...]) -> np.ndarray:
    """Centres in the number that sends the fewest candidates to lists, judged by samples: a member needs no less than its best score."""
    length = unit(anchors)[1]
    need = np.concatenate([(a @ candidates.T).max(axis=1) for a in np.array_split(anchors, max(1, len(anchors) // 256))]) / np.where(length > 0, length, 1)
    kept = None
    for n in numbers:
        c = centres(anchors, n)
        angle, _ = angles(anchors, c)
        of = angle.argmin(axis=1)
        widest, least = np.zeros(len(c)), np.full(len(c), np.inf)
        np.maximum.at(widest, of, angle[np.arange(len(of)), of])
        np.minimum.at(least, of, need)
        sent = float((bounds(candidates, c, widest) >= least).sum())
        if kept is None or sent < kept[0]:
            kept = (sent, c)
    return kept[1]


def _by_cluster(values: list, kind: str) -> Column:
    """``values[cluster]``."""
    return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1)


# The walk -----------------------------------------------------------------------------------------


class Walk:
    """The members of one group and the best candidates found so far for each of their windows."""

    def __init__(self, members: pa.Table, shape: Shape, k: int, same: bool):
        self.shape, self.k, self.same = shape, k, same
        members = members.combine_chunks()
        self.a, self.id, self.label, self.norm = (members.column(c).to_numpy() for c in ("a", "id", "label", "norm"))
        self.vectors = shape.scored(shape.matrix(members.column("vec").combine_chunks()))
        lists = members.column("windows").combine_chunks()
        flat = lists.flatten()
        self.of = np.repeat(np.arange(len(self.a)), lists.value_lengths().to_numpy())
        self.q, self.need, self.hi = (flat.field(x).to_numpy() for x in ("q", "lo", "hi"))
        self.need = self.need.copy()
        self.best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        """Window, score and id, in order."""

    def step(self, bound: float, ids: np.ndarray, labels: np.ndarray, vec: bytes) -> bool:
        """Scores a block of the list; False once no member can find anything in it or behind."""
        reach = self.norm[self.of] * bound
        active = np.flatnonzero(reach + SLACK >= self.need)
        if not len(active):
            return False
        v = self.shape.scored(self.shape.matrix(vec)).T
        found = [self.best]
        for lo in range(0, len(active), max(1, CELLS // len(ids))):
            w = active[lo : lo + max(1, CELLS // len(ids))]
            owners, at = np.unique(self.of[w], return_inverse=True)
            score = (self.vectors[owners] @ v)[at]
            own = self.of[w][:, None]
            good = (score >= self.need[w][:, None]) & (score <= self.hi[w][:, None]) & ((labels[None, :] == self.label[own]) == self.same) & (ids[None, :] != self.id[own])
            x, y = np.nonzero(good)
            found.append(self.top(w[x], score[x, y].astype(np.int64), ids[y]))
        self.best = self.top(*(np.concatenate(p) for p in zip(*found, strict=True)))
        window, score, _ = self.best
        full = np.flatnonzero(np.arange(len(window)) - np.searchsorted(window, window) == self.k - 1)
        self.need[window[full]] = score[full]
        return True

    def top(self, window: np.ndarray, score: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k best of each window, in order."""
        order = np.lexsort((key, -score, window))
        window = window[order]
        keep = np.arange(len(window)) - np.searchsorted(window, window) < self.k
        return window[keep], score[order[keep]], key[order[keep]]

    def result(self) -> pa.RecordBatch:
        window, score, key = self.best
        return pa.RecordBatch.from_arrays([pa.array(self.a[self.of[window]]), pa.array(self.q[window]), pa.array(score), pa.array(key)], ["a", "q", "score", "id"])


def walked(members: DataFrame, candidates: DataFrame, pieces: int, groups: int, shape: Shape, k: int, same: bool) -> DataFrame:
    """``a, q, score, id``: of every window the best candidates of each piece of the lists."""
    still = members.select(
        "cluster", "chunk", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("piece"), F.lit(0).alias("side"), F.lit(0.0).alias("bound"), "id", "label", "vec", "a", "norm", "windows",
        F.lit(None).cast("binary").alias("ids"), F.lit(None).cast("binary").alias("labels"),
    )
    # candidates in order of their bounds, members before them
    ordered = still.unionByName(candidates).repartition(min(groups, TASKS), "cluster", "chunk", "piece").sortWithinPartitions("cluster", "chunk", "piece", "side", F.desc("bound"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, walk, open_ = None, [], None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            place = np.stack([batch.column(c).to_numpy() for c in ("cluster", "chunk", "piece", "side")])
            cut = np.flatnonzero(np.append(True, (place[:, 1:] != place[:, :-1]).any(axis=0)))
            for lo, hi in zip(cut, np.append(cut[1:], batch.num_rows), strict=True):
                group, side, part = tuple(place[:3, lo]), place[3, lo], batch.slice(lo, hi - lo)
                if group != at:
                    if walk is not None:
                        yield walk.result()
                    at, held, walk, open_ = group, [], None, False
                if side == 0:
                    held.append(part)
                    continue
                if walk is None and held:
                    walk, held, open_ = Walk(pa.Table.from_batches(held), shape, k, same), [], True
                for i in range(part.num_rows if open_ else 0):
                    bound, ids, labels, vec = (part.column(c)[i].as_py() for c in ("bound", "ids", "labels", "vec"))
                    open_ = walk.step(bound, np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64), vec)
                    if not open_:
                        break
        if walk is not None:
            yield walk.result()

    return ordered.mapInArrow(run, "a bigint, q int, score bigint, id bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each window with their rank."""
    order = Window.partitionBy("a", "q").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "vector", label: str = "label", k: int = 5, low: int = 80, high: int = 100, clusters: tuple[int, ...] = CLUSTERS
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows that meet ``anchors`` (a condition on ``rows``).

    A row's score is its inner product with the anchor; components must be whole numbers, and shorter vectors count as filled up with zeros. Higher
    scores come first, then smaller ids. An anchor's positives are its first ``k`` other rows of its label. For each, the first ``k`` rows of other
    labels whose score is from ``low`` to ``high`` percent of the positive's are returned. Rows without a label or a vector, or with a component that is
    null or not finite, take no part. A row without an id is no anchor and comes last among equals. "Other rows" have another id; rows that
    repeat an id are candidates of their own, and repeated anchors count once. Other columns may have any name. No anchors: no rows.
    """
    used = usable(rows, anchors, key, vector, label)
    top = used.agg(
        F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0)), F.coalesce(F.max(F.array_max(F.transform("v", F.abs))), F.lit(0.0)),
        F.coalesce(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)), F.lit(0.0)),
    ).first()
    n, shape = top[0], Shape(max(1, top[1]), top[2], top[3])
    packed = stored(packed_rows(used, shape), "packed")
    own = packed.where("anchor").select("id", "label", "vec").dropDuplicates()

    def sampled(df: DataFrame) -> np.ndarray:
        found = df.orderBy(F.xxhash64("id", "vec"), "id").limit(SAMPLE).select("vec").toArrow()
        return shape.matrix(found.column("vec").combine_chunks())

    sample = sampled(own)
    if not len(sample):
        return _named(packed.sparkSession.createDataFrame([], "a bigint, p bigint, rank int, id bigint, ps bigint, score bigint"))
    candidates = sampled(packed)
    c = grouped(sample, candidates, clusters)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                angle, norm = angles(shape.matrix(b.column("vec")), c)
                of = angle.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(of.astype(np.int32)), pa.array(angle[np.arange(len(of)), of]), pa.array(norm)], ["id", "label", "vec", "cluster", "angle", "norm"])

    placed = own.mapInArrow(place, "id bigint, label bigint, vec binary, cluster int, angle double, norm double")
    members = stored(placed.withColumn("a", F.xxhash64("id", "label", "vec")), "members")
    # one row a cluster
    sizes = {r.cluster: r for r in members.groupBy("cluster").agg(F.count("*").alias("n"), F.max("angle").alias("widest")).collect()}
    widest = np.array([sizes[i].widest if i in sizes else 0.0 for i in range(len(c))])
    chunks = [-(-sizes[i].n // CHUNK) if i in sizes else 0 for i in range(len(c))]
    members = members.withColumn("chunk", F.pmod(F.xxhash64("a", F.lit(3)), _by_cluster(chunks, "long")).cast("int"))

    # as many tasks as the session wants, if there is enough to do
    wanted = min(int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // LEAST))
    pieces = max(1, -(-n // PIECE), -(-wanted // sum(chunks)))
    groups = max(1, sum(chunks) * pieces)
    copies = np.array(chunks)

    def listed(least: np.ndarray, below: np.ndarray) -> DataFrame:
        """The candidates of each cluster's list whose bound is in its range, once for each chunk of members."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                vec = shape.matrix(b.column("vec"))
                bound = bounds(vec, c, widest)
                ids, labels = b.column("id").to_numpy(), b.column("label").to_numpy()
                vec = vec.astype(shape.packed)
                for i in np.flatnonzero(copies):
                    at = np.flatnonzero((bound[:, i] >= least[i]) & (bound[:, i] < below[i]))
                    at = at[np.argsort(-bound[at, i], kind="stable")]
                    for part in np.split(at, range(BLOCK, len(at), BLOCK)):
                        if len(part):
                            packed_ids = ids[part].tobytes()
                            row = (i, zlib.crc32(packed_ids) % pieces, bound[part[0], i], packed_ids, labels[part].tobytes(), vec[part].tobytes())
                            n = int(copies[i])
                            yield pa.RecordBatch.from_arrays([pa.array([i] * n, pa.int32()), pa.array(range(n), pa.int32()), *(pa.array([x] * n, t) for x, t in zip(row[1:], types, strict=True))], names)

        names = ["cluster", "chunk", "piece", "bound", "ids", "labels", "vec"]
        types = [pa.int32(), pa.float64(), pa.binary(), pa.binary(), pa.binary()]
        out = packed.select("id", "label", "vec").mapInArrow(run, "cluster int, chunk int, piece int, bound double, ids binary, labels binary, vec binary")
        return out.select(
            "cluster", "chunk", "piece", F.lit(1).alias("side"), "bound", F.lit(None).cast("long").alias("id"), F.lit(None).cast("long").alias("label"), "vec",
            F.lit(None).cast("long").alias("a"), F.lit(0.0).alias("norm"), F.lit(None).cast("array<struct<q:int,lo:bigint,hi:bigint>>").alias("windows"), "ids", "labels",
        )

    def needed(windows: DataFrame) -> np.ndarray:
        """The least bound that any window of a cluster asks for: one number a cluster."""
        per = F.when(F.col("norm") > 0, F.col("lo") / F.col("norm")).otherwise(F.lit(float("-inf")))
        rows = windows.groupBy("cluster").agg(F.min(per).alias("least")).collect()
        least = {r.cluster: r.least - SLACK * (1 + abs(r.least)) if np.isfinite(r.least) else -np.inf for r in rows}
        return np.array([least.get(i, np.inf) for i in range(len(c))])

    def window(q: Column, lo: Column, hi: Column) -> Column:
        return F.struct(q.cast("int").alias("q"), lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))

    # positives: the heads of the lists, then what can still beat the k-th best
    heads = np.quantile(bounds(candidates, c, widest), 1 - HEAD, axis=0)
    every = np.full(len(c), np.inf)
    one = members.withColumn("windows", F.array(window(F.lit(0), F.lit(LOW), F.lit(HIGH))))
    head = stored(_best(walked(one, listed(heads, every), pieces, groups, shape, k, True), k), "heads")
    last = head.where(F.col("rank") == k).select("a", F.col("score").alias("lo"))
    known = stored(members.join(last, "a", "left").withColumn("lo", F.coalesce("lo", F.lit(LOW))), "known")
    rest = listed(needed(known), heads)
    more = walked(known.withColumn("windows", F.array(window(F.lit(0), F.col("lo"), F.lit(HIGH)))).drop("lo"), rest, pieces, groups, shape, k, True)
    positives = stored(_best(head.select("a", "q", "score", "id").unionByName(more), k), "positives")

    # negatives: a window of scores for each positive
    ranges = positives.select("a", F.col("rank").alias("q"), F.col("score").alias("ps"), F.col("id").alias("p"))
    lo = F.expr(f"CAST(CEIL(CAST(ps AS DECIMAL(20,0)) * {low} / 100) AS BIGINT)")
    hi = F.expr(f"CAST(FLOOR(CAST(ps AS DECIMAL(20,0)) * {high} / 100) AS BIGINT)")
    asked = ranges.withColumns({"lo": lo, "hi": hi}).where("lo <= hi")
    windows = stored(asked.join(members.select("a", "cluster", "norm"), "a"), "windows")
    lists = windows.groupBy("a").agg(F.collect_list(window(F.col("q"), F.col("lo"), F.col("hi"))).alias("windows"))
    looking = members.join(lists, "a")
    found = _best(walked(looking, listed(needed(windows), every), pieces, groups, shape, k, False), k)
    names = members.select("a", F.col("id").alias("anchor"))
    return _named(found.join(windows.select("a", "q", "p", "ps"), ["a", "q"]).join(names, "a").select(F.col("anchor").alias("a"), "p", "rank", "id", "ps", "score"))


def _named(df: DataFrame) -> DataFrame:
    known = lambda c: F.nullif(F.col(c), F.lit(int(NONE)))
    return df.select(F.col("a").alias("anchor_id"), known("p").alias("positive_id"), F.col("rank").cast("int").alias("rank"), known("id").alias("negative_id"), F.col("ps").alias("positive_score"), F.col("score").alias("negative_score"))
