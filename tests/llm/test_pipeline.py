import pytest

import corpus_pipeline as cp
from lexispark.llm.common import stored, table

from .helpers import frame, odd_rows, rows
from .test_decontam import brute as leaks
from .test_line_dedup import brute as line_digests
from .test_near_dup import brute as groups


@pytest.fixture(scope="module")
def written(spark, sf_dir):
    docs, out = table(spark, sf_dir, "documents"), []
    for name, stage in cp.STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        out.append(docs)
    return out


def test_every_stage_against_brute_force(spark, sf_dir, written):
    import hashlib

    raw = table(spark, sf_dir, "documents")
    before = [raw, *written[:-1]]
    data = [[tuple(r) for r in df.select(*cp.COLUMNS).collect()] for df in before]
    # all given texts have a language
    assert sorted(data[1]) == sorted(data[0])
    digests = {i: h for i, _, _, h in line_digests(data[1])}
    left = {r[0]: hashlib.sha256(r[1].encode()).hexdigest() for r in data[2]}
    assert all(digests[i] == h for i, h in left.items())
    empty = hashlib.sha256(b"").hexdigest()
    assert {i for i in digests if i not in left} == {i for i, h in digests.items() if h == empty}
    assert all(r[4] == len(r[1]) for r in data[2])
    component = groups(data[2], size=5)
    assert {r[0] for r in data[3]} == {i for i, c in component.items() if i == c}
    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    assert {r[0] for r in data[4]} == {r[0] for r in leaks(data[3], items) if not r[-1]}
    last = written[-1].collect()
    assert {(r.doc_id, r.decoded) for r in last} == {(r[0], r[1]) for r in data[4]} and all(r.exact for r in last)


def test_columns(written):
    assert all(df.columns == cp.COLUMNS for df in written[:-1])


def test_odd_rows_and_empty_tables(spark, sf_dir):
    for data in (odd_rows() + rows(["some more text of words"] * 2, 50), []):
        docs = frame(spark, data)
        for name, stage in cp.STAGES:
            docs = stored(stage(spark, docs, sf_dir), name)
        assert docs.where("NOT exact").count() == 0
