"""Folds, samples, parameter grids and learning curves."""

from __future__ import annotations

import itertools
import math
import time
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..functions.arrays import argmax, let
from ..session import cached, materialise, shuffles_removed, written
from . import lockstep as ls
from .labels import ClassSize, balanced_weights, class_sizes, class_table, label_at, position_of
from .lookup import MAX_BROADCAST_ROWS
from .metrics import summary
from .naive_bayes import NaiveBayes, weighted_sums
from .ordered import row_numbers, running_sums

# Default grid of Naive Bayes and the shares of a learning curve.
NAIVE_BAYES_GRID = {"alpha": [0.1, 0.5, 1.0, 1.5, 2.0], "fit_prior": [True, False]}
CURVE_SHARES = tuple(np.linspace(0.1, 1.0, 5))
TASKS_FOR_ONE = 16
"""Tasks of a pass for each core, from which the folds of a tree search are grown one after another."""


# Folds, samples, weights -------------------------------------------------------------------------


def fold_cuts(sizes: list[ClassSize], k: int) -> list[tuple]:
    """Per class the ranks after which the next fold starts.

    Classes are laid end to end in order of first appearance and dealt to the folds in turn;
    a class then gives every fold as many rows as it was dealt, in key order.
    """
    rows, start = [], 0
    for c in sorted(sizes, key=lambda s: s.first_key):
        dealt = [len(range(start + (i - start) % k, start + c.n, k)) for i in range(k)]
        rows.append((c.label, np.cumsum(dealt)[:-1].tolist()))
        start += c.n
    return rows


def stratified_folds(
    docs: DataFrame, k: int = 5, label: str = "label", key: str = "doc_id", sizes: list[ClassSize] | None = None
) -> DataFrame:
    """Add ``fold`` (0 to k-1): every class is cut, in key order, into k nearly equal runs.

    Give it narrow rows: the result is written to the checkpoint folder, as every fit reads it.
    """
    sizes = sizes or class_sizes(docs, label, key)
    if max(c.n for c in sizes) < k:
        raise ValueError(f"no class has {k} rows to spread over {k} folds")
    kind = docs.schema[label].dataType.simpleString()
    cuts = class_table(docs, fold_cuts(sizes, k), f"`{label}` {kind}, _cuts array<bigint>")
    ranked = row_numbers(docs.where(F.col(label).isNotNull()), [label], key, "_rank")
    fold = F.size(F.filter("_cuts", lambda c: c < F.col("_rank")))
    return materialise(ranked.join(cuts, label).select(*docs.columns, fold.alias("fold")))


def sample_quotas(sizes: list[ClassSize], size: int) -> dict:
    """Rows to take per class: proportional shares, leftovers to the largest remainders."""
    total = sum(c.n for c in sizes)
    exact = {c.label: size * c.n / total for c in sizes}
    quota = {label: int(x) for label, x in exact.items()}
    by_remainder = sorted(exact, key=lambda label: quota[label] - exact[label])
    for label in by_remainder[: size - sum(quota.values())]:
        quota[label] += 1
    return quota


def stratified_sample(
    docs: DataFrame,
    size: int,
    label: str = "label",
    key: str = "doc_id",
    seed: int = 42,
    sizes: list[ClassSize] | None = None,
) -> DataFrame:
    """Exactly ``size`` rows with the classes in proportion (all rows if there are no more).

    Rows are drawn by lowest seeded hash. Counts per hash prefix show which prefixes are taken
    whole, so only the few rows of one prefix per class are ever sorted.
    """
    sizes = sizes or class_sizes(docs, label, key)
    if sum(c.n for c in sizes) <= size:
        return docs.where(F.col(label).isNotNull())
    kind = docs.schema[label].dataType.simpleString()
    quotas = class_table(docs, list(sample_quotas(sizes, size).items()), f"`{label}` {kind}, _quota bigint")
    hashed = docs.withColumn("_hash", F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string"))))
    hashed = hashed.withColumn("_prefix", F.substring("_hash", 1, 3))
    per_prefix = hashed.groupBy(label, "_prefix").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy(label).orderBy("_prefix")) - F.col("_n")
    # a kept prefix holds a sampled row, so this table has at most `size` rows
    taken = per_prefix.withColumn("_before", before).join(quotas, label).where(F.col("_before") < F.col("_quota"))
    taken = taken.select(label, "_prefix", (F.col("_quota") - F.col("_before")).alias("_left"))
    if size <= MAX_BROADCAST_ROWS:
        taken = F.broadcast(taken)
    order = W.partitionBy(label, "_prefix").orderBy("_hash", key)
    return (
        hashed.join(taken, [label, "_prefix"])
        .withColumn("_row", F.row_number().over(order))
        .where(F.col("_row") <= F.col("_left"))
        .select(*docs.columns)
    )


def with_class_weights(docs: DataFrame, label: str = "label", sizes: list[ClassSize] | None = None) -> DataFrame:
    """Add ``class_weight``, which gives every class the same total weight."""
    sizes = sizes or class_sizes(docs, label)
    kind = docs.schema[label].dataType.simpleString()
    rows = list(balanced_weights(sizes).items())
    return docs.join(class_table(docs, rows, f"`{label}` {kind}, class_weight double"), label)


# Naive Bayes: all grid points and folds in one pass ----------------------------------------------


def _log_shares(counts: np.ndarray, fit_prior: bool) -> list[float]:
    """Log priors of one fit; a class it has not seen can never be predicted."""
    total, seen = counts.sum(), int((counts > 0).sum())
    return [
        -math.inf if n == 0 else math.log(n / total) if fit_prior else -math.log(seen) for n in counts.tolist()
    ]


def _predicted(points: Column, classes: list, dtype: DataType) -> Column:
    """Label of the highest ``s - w * den + prior`` for a point with arrays in class order."""
    m = len(classes)
    # a document without known terms has no sums
    filled = F.when(F.col("s").isNull(), F.array_repeat(F.lit(0.0), m)).otherwise(F.slice("s", points["at"] + 1, m))
    weight = F.coalesce("w", F.lit(0.0))
    reduced = F.zip_with(filled, points["den"], lambda s, d: s - weight * d)
    return label_at(argmax(F.zip_with(reduced, points["prior"], lambda s, p: s + p)), classes, dtype)


def naive_bayes_grid(
    features: DataFrame,
    docs: DataFrame,
    n_features: int,
    sizes: list[ClassSize] | None = None,
    variant: str = "multinomial",
    grid: dict | None = None,
    k: int = 5,
    key: str = "doc_id",
    max_features: int | None = None,
) -> DataFrame:
    """Weighted F1 per grid point and held-out fold: ``(alpha, fit_prior, fold, f1)``.

    ``docs`` has ``fold`` and ``label``, and ``features`` is its long table. Class sums per fold
    are taken once; what a fold trains on is the total minus the fold. All smoothing values are
    scored side by side while the held-out terms are read once.
    """
    grid = grid or NAIVE_BAYES_GRID
    sizes = sizes or class_sizes(docs, key=key)
    classes = [c.label for c in sizes]
    alphas, m = [float(a) for a in grid["alpha"]], len(classes)
    rows = features.select(key, "idx", "weight").join(docs.select(key, "label", "fold"), key)

    def sums_of(condition) -> list[Column]:
        return [F.sum(F.when(condition & (F.col("label") == F.lit(c)), F.col("weight")).otherwise(0.0)) for c in classes]

    # one row per term: its weight per fold and class, and per class
    per_fold = [x for f in range(k) for x in sums_of(F.col("fold") == f)]
    sums = materialise(
        rows.groupBy("idx").agg(F.array(*per_fold).alias("n"), F.array(*sums_of(F.lit(True))).alias("all"))
    )

    def numerators(f: Column) -> Column:
        held_in = F.zip_with("all", F.slice("n", f * m + 1, m), lambda a, x: F.greatest(a - x, F.lit(0.0)))
        smooth = F.array(*map(F.lit, alphas))
        if variant == "multinomial":
            logs = let(held_in, lambda t: F.transform(smooth, lambda a: F.transform(t, lambda x: F.log(x + a))))
        else:
            total = lambda t: F.aggregate(t, F.lit(0.0), lambda acc, x: acc + x)
            logs = let(
                held_in,
                lambda t: let(
                    total(t), lambda w: F.transform(smooth, lambda a: F.transform(t, lambda x: -F.log(w - x + a)))
                ),
            )
        return F.struct(f.alias("fold"), F.flatten(logs).alias("logp"))

    table = sums.select("idx", F.explode(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), numerators)).alias("e"))
    table = table.select("idx", "e.fold", "e.logp")
    bound = max_features * k if max_features else None
    scores = weighted_sums(rows, table, len(alphas) * m, [key, "fold"], ["idx", "fold"], max_rows=bound)

    # k times m numbers each, whatever the size of the data
    weights = np.array(sums.agg(F.array(*[F.sum(F.col("n")[i]) for i in range(k * m)])).first()[0]).reshape(k, m)
    found = docs.groupBy("fold", "label").agg(F.count("*").alias("n")).collect()
    counts = np.zeros((k, m))
    for r in found:
        counts[r.fold, classes.index(r.label)] = r.n
    points = []
    for f in range(k):
        held_in, seen = weights.sum(0) - weights[f], counts.sum(0) - counts[f]
        for a, alpha in enumerate(alphas):
            if variant == "multinomial":
                den = np.log(held_in + alpha * n_features)
            else:
                den = -np.log(held_in.sum() - held_in + alpha * n_features)
            for fit_prior in grid["fit_prior"]:
                prior = _log_shares(seen, fit_prior)
                if variant == "complement":
                    prior = [-math.inf if p == -math.inf else 0.0 for p in prior]
                points.append((f, alpha, fit_prior, a * m, den.tolist(), prior))
    points = docs.sparkSession.createDataFrame(
        points, "fold int, alpha double, fit_prior boolean, at int, den array<double>, prior array<double>"
    )
    points = points.groupBy("fold").agg(F.collect_list(F.struct("alpha", "fit_prior", "at", "den", "prior")).alias("points"))

    by = ["alpha", "fit_prior", "fold"]
    scored = (
        docs.select(key, "label", "fold")
        .join(scores.drop("fold"), key, "left")
        .join(F.broadcast(points), "fold")
        .select("label", "fold", "s", "w", F.explode("points").alias("p"))
        .select(
            "label",
            "fold",
            "p.alpha",
            "p.fit_prior",
            _predicted(F.col("p"), classes, docs.schema["label"].dataType).alias("prediction"),
        )
    )
    return summary(scored, by).select(*by, F.col("f1_score").alias("f1"))


def grid_means(results: DataFrame, params: Sequence[str]) -> DataFrame:
    """Mean score over the folds per grid point."""
    return results.groupBy(*params).agg(F.avg("f1").alias("mean_f1"), F.stddev_pop("f1").alias("std_f1"))


def best_point(results: DataFrame, params: Sequence[str], grid: dict | None = None) -> DataFrame:
    """The grid point with the best mean score; the first in the grid's order among equals."""
    grid = grid or NAIVE_BAYES_GRID
    places = [F.array_position(F.array(*[F.lit(v) for v in grid[p]]), F.col(p)) if p in grid else F.col(p) for p in params]
    return grid_means(results, params).orderBy(F.desc(F.round("mean_f1", 12)), *places).limit(1)


def tuned_naive_bayes(
    results: DataFrame,
    features: DataFrame,
    sizes: list[ClassSize],
    n_features: int,
    held_out: tuple[DataFrame, DataFrame] | None = None,
) -> tuple[NaiveBayes, DataFrame]:
    """The model of a search's best point, fitted on all rows searched, and a report of one row.

    The report has the point and its score over the folds and, for ``held_out`` (long features and documents that the search
    has not seen), the number of rows and the label metrics on them.
    """
    best = best_point(results, ["alpha", "fit_prior"]).first()
    model = NaiveBayes(alpha=best.alpha, fit_prior=best.fit_prior).fit(features, sizes, n_features)
    point = [F.lit(best[c]).alias(c) for c in ("alpha", "fit_prior", "mean_f1", "std_f1")]
    if held_out is None:
        return model, results.sparkSession.range(1).select(*point)
    scored = model.predict(*held_out).where(F.col("label").isNotNull())
    measured = summary(scored.withColumn("held_out", F.lit(1)), ["held_out"]).drop("held_out")
    return model, measured.select(*point, *[F.col(c).alias(f"held_out_{c}") for c in measured.columns])


def curve_sizes(n_train: int, shares: Sequence[float] = CURVE_SHARES) -> list[int]:
    """Absolute training sizes of a learning curve."""
    return sorted({max(int(s * n_train), 1) for s in shares})


def naive_bayes_curve(
    features: DataFrame,
    docs: DataFrame,
    n_features: int,
    sizes: list[ClassSize] | None = None,
    shares: Sequence[float] = CURVE_SHARES,
    alpha: float = 1.0,
    fit_prior: bool = True,
    k: int = 5,
    key: str = "doc_id",
    max_features: int | None = None,
    variant: str = "multinomial",
) -> DataFrame:
    """Weighted F1 on the rows trained on and on the held-out fold, per size and fold.

    For every fold the other folds' rows are taken in key order and the first ``train_size`` of
    them are trained on. ``docs`` has ``fold`` and ``label``; all fits are one aggregation.
    """
    sizes = sizes or class_sizes(docs, key=key)
    classes = [c.label for c in sizes]
    m = len(classes)
    first_fold = sum(cuts[0] for _, cuts in fold_cuts(sizes, k))
    steps = curve_sizes(sum(c.n for c in sizes) - first_fold, shares)
    r = len(steps)

    sums = {"_all": F.lit(1), **{f"_f{f}": (F.col("fold") == f).cast("int") for f in range(k)}}
    ranked = running_sums(docs.select(key, "label", "fold").withColumn("_g", F.lit(0)), ["_g"], key, sums)
    uses = [F.struct(F.lit(f).alias("held_out"), (F.col("_all") - F.col(f"_f{f}")).alias("rank")) for f in range(k)]
    first = F.size(F.filter(F.array(*map(F.lit, steps)), lambda s: s < F.col("u.rank")))
    # one row per document and held-out fold; `first` is the first step that trains on it
    roles = materialise(
        ranked.select(key, "label", "fold", F.explode(F.array(*uses)).alias("u")).select(
            key,
            "label",
            "u.held_out",
            F.when(F.col("fold") == F.col("u.held_out"), F.lit(-1)).otherwise(first).alias("first"),
        )
    )
    rows = features.select(key, "idx", "weight").join(roles, key)

    cells = [
        (F.col("first") >= 0) & (F.col("first") <= s) & (F.col("label") == F.lit(c)) for s in range(r) for c in classes
    ]
    by_term = materialise(
        rows.groupBy("held_out", "idx").agg(
            F.array(*[F.sum(F.when(cell, F.col("weight")).otherwise(0.0)) for cell in cells]).alias("n")
        )
    )
    n = [F.col("n")[i] for i in range(r * m)]
    if variant == "multinomial":
        logs = [F.log(x + F.lit(float(alpha))) for x in n]
    else:
        logs = [-F.log(sum(n[i - i % m : i - i % m + m], F.lit(float(alpha))) - n[i]) for i in range(r * m)]
    table = by_term.select("held_out", "idx", F.array(*logs).alias("logp"))
    bound = max_features * k if max_features else None
    scores = weighted_sums(rows, table, r * m, [key, "held_out"], ["held_out", "idx"], max_rows=bound)

    # k rows of r times m numbers each, whatever the size of the data
    totals = by_term.groupBy("held_out").agg(F.array(*[F.sum(F.col("n")[i]) for i in range(r * m)]).alias("t"))
    counts = roles.groupBy("held_out").agg(F.array(*[F.count_if(cell) for cell in cells]).alias("c"))
    points = []
    for row in totals.join(counts, "held_out").collect():
        weight, seen = np.array(row.t).reshape(r, m), np.array(row.c).reshape(r, m)
        for s in range(r):
            prior = _log_shares(seen[s], fit_prior)
            if variant == "multinomial":
                den = np.log(weight[s] + alpha * n_features)
            else:
                den = -np.log(weight[s].sum() - weight[s] + alpha * n_features)
                prior = [p if p == -math.inf else 0.0 for p in prior]
            points.append((row.held_out, s, steps[s], s * m, den.tolist(), prior))
    schema = "held_out int, step int, train_size bigint, at int, den array<double>, prior array<double>"
    points = docs.sparkSession.createDataFrame(points, schema)
    points = points.groupBy("held_out").agg(F.collect_list(F.struct("step", "train_size", "at", "den", "prior")).alias("points"))

    part = F.when(F.col("first") < 0, "test").when(F.col("first") <= F.col("p.step"), "train")
    scored = (
        roles.join(scores, [key, "held_out"], "left")
        .join(F.broadcast(points), "held_out")
        .select("label", "held_out", "first", "s", "w", F.explode("points").alias("p"))
        .select(
            "label",
            F.col("held_out").alias("fold"),
            "p.train_size",
            part.alias("part"),
            _predicted(F.col("p"), classes, docs.schema["label"].dataType).alias("prediction"),
        )
        .where(F.col("part").isNotNull())
    )
    f1 = summary(scored, ["train_size", "fold", "part"])
    return f1.groupBy("train_size", "fold").agg(
        F.max(F.when(F.col("part") == "train", F.col("f1_score"))).alias("train_f1"),
        F.max(F.when(F.col("part") == "test", F.col("f1_score"))).alias("test_f1"),
    )


# Any classifier ------------------------------------------------------------------------------------


def parameter_grid(axes: dict[str, list], valid: Callable[[dict], bool] = lambda p: True) -> list[dict]:
    """Every combination of the axes that ``valid`` accepts."""
    names = sorted(axes)
    points = (dict(zip(names, values)) for values in itertools.product(*(axes[n] for n in names)))
    return [p for p in points if valid(p)]


def _f1_on(model_of: Callable, params: dict, train: DataFrame, parts: Sequence[DataFrame]) -> list[float | None]:
    """Weighted F1 on every part; no scores where the rows cannot be fitted (a single class)."""
    if train.select("label").distinct().limit(2).count() < 2:
        return [None] * len(parts)
    model = model_of(**params).fit(train)
    return [summary(model.predict(part)).first().f1_score for part in parts]


def lockstep_scores(model_of, vectors: DataFrame, grid: list[dict], k: int) -> list[dict]:
    """``point, fold, f1, iterations, residual`` of a linear model for all points and folds, fitted side by side.

    ``residual`` is the largest entry of the penalised gradient at the end. A fold whose other rows have one class only has no score.
    """
    classes = [c.label for c in class_sizes(vectors, key=vectors.columns[0])]
    known = vectors.where(F.col("label").isNotNull())
    weight = None
    if any(p.get("class_weight") for p in grid):
        if len({p.get("class_weight") for p in grid}) > 1:
            raise ValueError("one search has one class_weight")
        known = with_class_weights(known)
        weight = F.col("class_weight")
    size = ls.width_of(known)
    rows = cached(ls.rows_of(known, position_of(F.col("label"), classes), weight, F.col("fold")))
    try:
        problem = ls.Problem(rows, size, len(classes))
        folds = [f for f in range(k) if problem.classes_seen(f) > 1]
        shared = model_of.paths(grid, folds, problem)
        paths = [ls.Path(*key, tuple(sorted(stops, reverse=True))) for key, stops in shared.items()]
        found = {(p[:-1], stop): s for p, stops in zip(paths, ls.solve(problem, paths), strict=True) for stop, s in zip(p.stops, stops, strict=True)}
        out, machines, place = [], [], {}
        for i, params in enumerate(grid):
            for f in range(k):
                if f not in folds:
                    out.append({"point": i, "fold": f, "f1": None, "iterations": None, "residual": None, "machine": None})
                    continue
                stops = [found[tuple(key), stop] for key, stop in model_of.fit_of(params, f, problem)]
                # points that end at the same place are scored once
                same = (f, *(id(s.weights) for s in stops))
                if same not in place:
                    place[same] = len(machines)
                    machines.append((f, np.concatenate([s.weights for s in stops], axis=1)))
                out.append({"point": i, "fold": f, "iterations": max(s.iterations for s in stops), "residual": max(s.residual for s in stops), "machine": place[same]})
        cells = problem.confusion(machines) if machines else []
    finally:
        rows.unpersist()
    for row in out:
        at = row.pop("machine")
        row["f1"] = None if at is None else ls.weighted_f1(cells[at])
    return out


def grid_search(
    model_of: Callable,
    vectors: DataFrame,
    grid: list[dict],
    k: int = 5,
    parallelism: int = 4,
    validation: DataFrame | None = None,
) -> tuple[object, dict]:
    """Fit every grid point on every fold, then the best one on all rows.

    ``vectors`` holds ``fold``, ``label`` and ``features`` and should be cached. Fits run as
    concurrent Spark jobs from a bounded thread pool; only one score per point and fold reaches the
    driver. The trees of a fold (``fold_scores``) and linear models (``paths``) are fitted side by side.
    """
    start = time.time()
    tasks = [(i, f) for i in range(len(grid)) for f in range(k)]
    if hasattr(model_of, "paths"):
        scores = [r["f1"] for r in lockstep_scores(model_of, vectors, grid, k)]
        return _searched(model_of, vectors, grid, tasks, scores, k, validation, start)
    held_out = F.col("fold")
    if hasattr(model_of, "fold_scores"):
        sizes = class_sizes(vectors, key=vectors.columns[0])
        classes = [c.label for c in sizes]
        # folds whose passes fill the cluster gain nothing side by side, but would share the disk
        if model_of.tasks(sum(c.n for c in sizes)) >= TASKS_FOR_ONE * vectors.sparkSession.sparkContext.defaultParallelism:
            parallelism = 1
        with shuffles_removed(vectors.sparkSession), ThreadPool(max(1, min(parallelism, k))) as pool:
            folds = pool.map(lambda f: model_of.fold_scores(vectors.where(held_out != f), vectors.where(held_out == f), classes, grid), range(k), chunksize=1)
        return _searched(model_of, vectors, grid, tasks, [folds[f][i] for i, f in tasks], k, validation, start)

    def run(task):
        i, f = task
        return _f1_on(model_of, grid[i], vectors.where(held_out != f), [vectors.where(held_out == f)])[0]

    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        scores = pool.map(run, tasks, chunksize=1)
    return _searched(model_of, vectors, grid, tasks, scores, k, validation, start)


def _searched(model_of: Callable, vectors: DataFrame, grid: list[dict], tasks: list, scores: list, k: int, validation: DataFrame | None, start: float) -> tuple[object, dict]:
    """The best point fitted on all rows, and the report of a search."""
    spark = vectors.sparkSession
    rows = [
        ({name: str(value) for name, value in grid[i].items()}, i, f, score) for (i, f), score in zip(tasks, scores)
    ]
    results = spark.createDataFrame(rows, "params map<string,string>, point int, fold int, f1 double")
    means = np.array(scores, dtype=float).reshape(len(grid), k).mean(axis=1)
    best = int(np.argmax(np.nan_to_num(np.round(means, 12), nan=-1.0)))
    model = model_of(**grid[best]).fit(vectors)
    report = {
        "best_params": grid[best],
        "best_score": float(means[best]),
        "cv_results": results,
        "optimization_time": time.time() - start,
    }
    if validation is not None:
        report["validation"] = summary(model.predict(validation))
    return model, report


def learning_curve(
    model_of: Callable,
    vectors: DataFrame,
    shares: Sequence[float] = CURVE_SHARES,
    k: int = 5,
    parallelism: int = 4,
    key: str = "doc_id",
) -> DataFrame:
    """Learning curve of any classifier over a sample with ``fold``: ``(train_size, fold, train_f1, test_f1)``.

    Rows are ranked once, by key, for every fold left out; a training set is then a filter, so vectors stay where they are.
    """
    n_first = vectors.where(F.col("fold") != 0).count()
    steps = curve_sizes(n_first, shares)
    tasks = [(s, f) for s in steps for f in range(k)]
    sums = {f"_r{f}": (F.col("fold") != f).cast("int") for f in range(k)}
    ranks = running_sums(vectors.select(key, "fold").withColumn("_g", F.lit(0)), ["_g"], key, sums).drop("_g", "fold")
    vectors = written(vectors.join(ranks, key), "ranked")
    names = [c for c in vectors.columns if c not in sums]

    def run(task):
        size, f = task
        train = vectors.where((F.col("fold") != f) & (F.col(f"_r{f}") <= size)).select(*names)
        parts = _f1_on(model_of, {}, train, [train, vectors.where(F.col("fold") == f)])
        return size, f, *parts

    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        rows = pool.map(run, tasks)
    schema = "train_size bigint, fold int, train_f1 double, test_f1 double"
    return vectors.sparkSession.createDataFrame(rows, schema)
