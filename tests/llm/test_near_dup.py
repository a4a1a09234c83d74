import random

import numpy as np
import pytest

from lexispark.llm import near_dup as nd
from lexispark.llm import spans as sp
from lexispark.llm.components import components

from .helpers import frame, odd_rows, rows, words


def shingles(text, size):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set()


def brute(data, size=2, limit=80):
    """Component of each id by all pairs."""
    ids = sorted({r[0] for r in data if r[0] is not None})
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [(r[0], shingles(r[1], size)) for r in data if r[0] is not None]
    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= limit * len(s | t):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


def check(spark, data, **options):
    got = nd.near_groups(frame(spark, data), **options).collect()
    assert len(got) == len(data)
    want = brute(data, **options)
    for r in got:
        assert r.component_id == want.get(r.doc_id), r
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)
    assert sorted(r.n_shingles for r in got) == sorted(len(shingles(r[1], options.get("size", 2))) for r in data)


def copies(n, length=60, edits=6, seed=1):
    random.seed(seed)
    base = [f"w{random.randint(0, 500)}" for _ in range(length)]
    out = []
    for _ in range(n):
        c = base[:]
        for _ in range(random.randint(0, edits)):
            c[random.randrange(length)] = f"e{random.randint(0, 10**6)}"
        out.append(" ".join(c))
    return out


def test_groups_equal_brute_force(spark):
    data = odd_rows() + rows(copies(120) + copies(40, 25, 3, 2) + ["one two"] * 30 + ["a", "A", "b"], 100)
    check(spark, data)


def test_five_word_shingles(spark):
    check(spark, rows(copies(80, 200, 5, 3) + ["too few words"] * 3), size=5)


def test_blocks_of_a_bucket(spark, monkeypatch):
    """Buckets cut into many blocks, and sets dealt over many, lose nothing."""
    monkeypatch.setattr(nd, "BLOCK", 7)
    monkeypatch.setattr(nd, "HELD", 5)
    monkeypatch.setattr(nd, "PART", 9)
    monkeypatch.setattr(nd, "HELD_BYTES", 2000)
    monkeypatch.setattr(nd, "PASSING", 3)
    check(spark, rows(copies(150, 60, 9, 4)))


def test_empty_table(spark):
    assert nd.near_groups(frame(spark, [])).count() == 0


def sketch(items):
    h = sp.mix(np.array(sorted(items), np.uint64))
    return nd.registers(np.zeros(len(h), np.int64), h, 1)


def test_registers_merge_by_maximum():
    a, b = set(range(1, 400)), set(range(300, 900))
    assert (np.maximum(sketch(a), sketch(b)) == sketch(a | b)).all()


@pytest.mark.parametrize("shared", [0, 200, 640, 800, 1000])
def test_estimate_is_near_the_similarity(shared):
    a, b = set(range(1, 1001)), set(range(1001 - shared, 2001 - shared))
    got = nd.likely_similarity(sketch(a), sketch(b), np.array([1000]), np.array([1000]))[0]
    assert abs(got - shared / (2000 - shared)) < 0.1


def test_components_of_a_chain(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 200)]
    got = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in got} == {i: 0 for i in range(41)} | {100: 100, 101: 100}
