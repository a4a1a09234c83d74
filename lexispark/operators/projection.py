"""Projection of documents onto two or three components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cached
from .lookup import MAX_BROADCAST_ROWS, lookup_join

METHODS = ("pca", "svd")
BLOCK = 6
"""Directions a pass works on; more than are wanted, so that close components part sooner."""
MAX_BLOCKS = 6
"""Blocks kept before the space is cut back to its best two."""
TOLERANCE = 1e-9
MAX_PASSES = 500


def _products(entries: DataFrame, terms: np.ndarray, directions: np.ndarray, mean: np.ndarray | None, n: int, key: str) -> np.ndarray:
    """The (centred) Gram matrix times ``directions`` (terms by columns): two aggregations over the entries."""
    width = directions.shape[1]
    names = [f"v{i}" for i in range(width)]
    table = entries.sparkSession.createDataFrame(
        [(int(i), *map(float, row)) for i, row in zip(terms, directions)], "idx int, " + ", ".join(f"{c} double" for c in names)
    )
    placed = lookup_join(entries, table, "idx", salt_by=key, max_rows=len(terms), limit=MAX_BROADCAST_ROWS // width)
    sums = placed.groupBy(key).agg(*[F.sum(F.col("weight") * F.col(c)).alias(c) for c in names])
    back = entries.join(sums, key).groupBy("idx").agg(*[F.sum(F.col("weight") * F.col(c)).alias(c) for c in names])
    found = {r[0]: r[1:] for r in back.collect()}  # one row a term
    out = np.array([found[i] for i in terms.tolist()])
    # centring takes one rank off: sum of (x - m)(x - m)' = X'X - n m m'
    return out if mean is None else out - n * np.outer(mean, mean @ directions)


def _loadings(features: DataFrame, n: int, method: str, k: int, key: str) -> tuple[np.ndarray, np.ndarray]:
    """Columns that any document has, and their loadings by components.

    Block subspace iteration with the residuals as new directions, until the residual of every wanted component is below
    ``TOLERANCE`` of the largest eigenvalue. Only terms by ``BLOCK`` numbers move in a pass, and no matrix of terms by terms is made.
    """
    entries = cached(features.select(key, "idx", "weight").repartition(key))
    totals = sorted(entries.groupBy("idx").agg(F.sum("weight").alias("s")).collect())
    terms = np.array([r.idx for r in totals], np.int64)
    mean = np.array([r.s for r in totals]) / max(1, n) if method == "pca" else None
    d = len(terms)
    block = np.linalg.qr(np.random.default_rng(0).standard_normal((d, min(BLOCK, d))))[0]
    basis, image = np.zeros((d, 0)), np.zeros((d, 0))
    for _ in range(MAX_PASSES):
        if not block.shape[1]:
            break
        basis, image = np.hstack([basis, block]), np.hstack([image, _products(entries, terms, block, mean, n, key)])
        small = basis.T @ image
        values, turns = np.linalg.eigh((small + small.T) / 2)
        values, turns = values[::-1], turns[:, ::-1]
        best = turns[:, :BLOCK]
        residuals = image @ best - (basis @ best) * values[:BLOCK]
        size = np.linalg.norm(residuals, axis=0)
        limit = TOLERANCE * max(values[0], 0.0)
        if (size[:k] <= limit).all():
            break
        if basis.shape[1] > BLOCK * MAX_BLOCKS:
            kept = turns[:, : 2 * BLOCK]
            basis, image = basis @ kept, image @ kept
        block = _new_directions(residuals[:, size > limit], basis)
    else:
        raise RuntimeError(f"no convergence of the components in {MAX_PASSES} passes")
    entries.unpersist()
    loadings = np.zeros((d, k))
    found = basis @ turns[:, :k] if d else loadings
    loadings[:, : found.shape[1]] = found
    # the sign of a component is free: make its largest loading positive
    largest = np.abs(loadings).argmax(axis=0) if d else np.zeros(0, int)
    return terms, loadings * np.where(loadings[largest, range(k)] < 0, -1.0, 1.0) if d else loadings


def _new_directions(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``block`` adds to ``basis``."""
    block = block / np.linalg.norm(block, axis=0)
    for _ in range(2):  # the second time takes off what rounding left
        block = block - basis @ (basis.T @ block)
        u, s, _ = np.linalg.svd(block, full_matrices=False)
        block = u[:, s > 1e-8]
    return block[:, : basis.shape[0] - basis.shape[1]]


def project(
    features: DataFrame, docs: DataFrame, vectors: DataFrame | None = None, method: str = "pca", n_components: int = 2, key: str = "doc_id"
) -> DataFrame:
    """Coordinates ``c1 .. ck`` of every document of ``docs``.

    The loadings, features by components, are found from the long table; documents are then projected by joining
    it with them. PCA coordinates are centred, SVD coordinates are not. ``vectors`` is not needed any more.
    """
    if n_components not in (2, 3):
        raise ValueError("n_components must be 2 or 3")
    method = method.lower()
    if method not in METHODS:
        raise ValueError(f"unknown method '{method}', expected one of {', '.join(METHODS)}")
    terms, loadings = _loadings(features, docs.count(), method, n_components, key)
    names = [f"c{i + 1}" for i in range(n_components)]
    table = docs.sparkSession.createDataFrame(
        [(int(i), *map(float, row)) for i, row in zip(terms, loadings)], "idx int, " + ", ".join(f"{n} double" for n in names)
    )
    sums = (
        lookup_join(features.select(key, "idx", "weight"), table, "idx", salt_by=key, max_rows=len(terms))
        .groupBy(key)
        .agg(*[F.sum(F.col("weight") * F.col(n)).alias(n) for n in names])
    )
    kept = [c for c in docs.columns if c != "tokens"]
    out = docs.select(*kept).join(sums, key, "left").fillna(0.0, names)
    if method == "svd":
        return out
    mean = out.agg(*[F.avg(n).alias(n) for n in names]).select(F.struct("*").alias("m")).scalar()
    centred = out.withColumn("m", mean)
    return centred.select(*kept, *[(F.col(n) - F.col(f"m.{n}")).alias(n) for n in names])
