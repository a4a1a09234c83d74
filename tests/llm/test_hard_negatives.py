import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexispark.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, vector array<double>, label int, id string, label2 string, a string, Cluster string, anchor string, v string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d", "e", "f") for r in rows], SCHEMA)


def brute(rows, k=5):
    """All scores of all anchors, as whole numbers of any size."""
    last = lambda i: (i is None, i or 0)
    used = [(i, v, y) for i, v, y in rows if y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    anchors = {(i, tuple(v), y) for i, v, y in used if i is not None and i % 10 == 0}
    out = []
    for i, v, y in anchors:
        scored = [(-sum(int(p) * int(q) for p, q in zip(v, w, strict=False)), last(j), j, z) for j, w, z in used if j != i]
        scored.sort(key=lambda r: r[:2])
        for s, _, j, _ in [r for r in scored if r[3] == y][:k]:
            negatives = [r for r in scored if r[3] != y and 80 * -s <= 100 * -r[0] <= 100 * -s][:k]
            out += [(i, j, n + 1, r[2], -s, -r[0]) for n, r in enumerate(negatives)]
    return sorted(out, key=str)


def ours(spark, rows, **more):
    found = hn.hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0, **more)
    return sorted((tuple(r) for r in found.collect()), key=str)


def vectors(n, dim, spread=1.0, seed=1):
    random.seed(seed)
    middle = np.random.default_rng(seed).normal(0, 40, (5, dim))
    noise = np.random.default_rng(seed + 1).normal(0, 40 * spread, (n, dim))
    return [(i, np.floor(middle[i % 5] + noise[i]).tolist(), random.choice([i % 5, i % 5, 7])) for i in range(n)]


@pytest.mark.parametrize("spread", [0.1, 1.0])
def test_equals_brute_force(spark, spread):
    rows = vectors(600, 12, spread)
    assert ours(spark, rows) == brute(rows) and brute(rows)


def test_many_pieces_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(hn, "PIECE", 97)
    monkeypatch.setattr(hn, "CHUNK", 4)
    monkeypatch.setattr(hn, "BLOCK", 16)
    monkeypatch.setattr(hn, "SAMPLE", 16)
    rows = vectors(400, 8)
    # a third of all rows are one vector, anchors among them
    rows += [(1000 + i, [30.0, -20.0, 5.0, 0.0, 1.0, 2.0, 3.0, 4.0], i % 3) for i in range(200)]
    assert ours(spark, rows, clusters=(3,)) == brute(rows)


def test_walks_end_before_their_lists():
    """Members of a narrow cluster stop as soon as the bound certifies it."""
    import pyarrow as pa

    random.seed(1)
    c = np.array([[1.0, 0.0]])
    m = np.array([[100.0, i] for i in range(-5, 6)])
    shape = hn.Shape(2, 1000, 1e7)
    angle, norm = hn.angles(m, c)
    windows = pa.array([[{"q": 0, "lo": hn.LOW, "hi": hn.HIGH}]] * len(m))
    members = pa.table({"a": range(len(m)), "id": range(1000, 1000 + len(m)), "label": [1] * len(m), "norm": norm, "vec": pa.array([r.astype("<i2").tobytes() for r in m], pa.binary()), "windows": windows})
    v = np.array([[np.cos(t) * 100, np.sin(t) * 100] for t in np.linspace(0, np.pi, 5000)]).round()
    bound = hn.bounds(v, c, np.array([angle.max()]))[:, 0]
    assert (bound[:, None] * norm[None, :] >= v @ m.T).all()
    order = np.argsort(-bound)
    walk, steps = hn.Walk(members, shape, 5, True), 0
    for lo in range(0, 5000, 100):
        at = order[lo : lo + 100]
        if not walk.step(bound[at[0]], at, np.ones(100, np.int64), v[at].astype("<i2").tobytes()):
            break
        steps += 1
    assert steps < 10
    got = walk.result().to_pydict()
    want = [sorted(-(v @ r))[:5] for r in m]
    assert got["score"] == [-int(s) for w in want for s in w]


def test_narrow_clusters_get_more_lists():
    rng = np.random.default_rng(3)
    middle = rng.normal(0, 100, (16, 20))
    near = middle[rng.integers(0, 16, 2000)] + rng.normal(0, 5, (2000, 20))
    spread = rng.normal(0, 100, (2000, 20))
    assert len(hn.grouped(near[:200], near, (4, 16, 64))) >= 16 and len(hn.grouped(spread[:200], spread, (4, 16, 64))) == 4


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 7), 3.0, -float(i % 5)], i % 3) for i in range(40)]
    rows += [(50, None, 1), (60, [1.0, None, 2.0], 1), (70, [nan, 1.0, 2.0], 1), (80, [inf, 1.0, 2.0], 0), (90, [1.0, 2.0, 3.0], None), (None, [5.0, 3.0, 0.0], 1), (None, [5.0, 3.0, 0.0], 2)]
    rows += [(100, [0.0, 0.0, 0.0], 0), (110, [], 1), (120, [2.0, 9.0], 2), (-10, [-3.0, -3.0, 1.0], 0), rows[3], rows[10], rows[10], (10, [6.0, 6.0, 6.0], 1)]
    assert ours(spark, rows) == brute(rows) and ours(spark, []) == [] and ours(spark, rows[1:10]) == []
    assert ours(spark, [(0, [1.0], 0)]) == [] and ours(spark, [(i, [0.0, 0.0], i % 2) for i in range(0, 40, 5)]) == brute([(i, [0.0, 0.0], i % 2) for i in range(0, 40, 5)])


@pytest.mark.parametrize("size", [3000.0, 1e6, 2e8])
def test_components_of_any_size(spark, size):
    rows = [(i, np.floor(np.array(v) * size / 100).tolist(), y) for i, v, y in vectors(120, 4)]
    assert ours(spark, rows) == brute(rows)
