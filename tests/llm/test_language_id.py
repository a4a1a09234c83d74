import zlib
from itertools import product

import numpy as np
from pyspark.sql import functions as F

from lexispark.llm import language_id as li
from lexispark.llm.common import table

from .helpers import frame, odd_rows, rows


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(1)
    length = np.array([4, 0, 1, 5, 3])
    score = rng.normal(0, 6, (length.sum(), 3)).astype(np.float32)
    got, at = li.viterbi(score, length, penalty=4.0), 0
    for n in length:
        part = score[at : at + n]
        value = lambda path: sum(part[i, s] for i, s in enumerate(path)) - 4.0 * sum(a != b for a, b in zip(path[:-1], path[1:], strict=True))  # noqa: B023, E731
        if n:
            best = max(product(range(3), repeat=int(n)), key=value)
            assert abs(value(best) - value(tuple(got[at : at + n]))) < 1e-4
        at += n


def test_held_out_accuracy(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got = li.languages(docs).collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert len(held) > 40 and sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)


def test_mixed_text_has_spans(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("length(text) > 400")
    model = li.train(docs)
    some = {r.lang: r.text[:300] for r in docs.select("lang", "text").collect()}
    mixed = frame(spark, rows([some["de"] + "\n" + some["es"], "привет", "12 34 — !", None, ""]))
    got = li.identify(mixed, model).orderBy("doc_id").collect()
    long = [s for s in got[0].spans if s.length > 100]
    assert [s.lang for s in long] == ["de", "es"] and abs(long[1].start - 301) < 40
    assert got[1].lang_pred in model.names
    assert [(r.lang_pred, r.score, r.spans) for r in got[2:]] == [("und", 0.0, [])] * 3


def test_script_narrows_candidates(spark):
    data = [(i, t, lang, *rows([""])[0][3:]) for i, (t, lang) in enumerate([("слово и дело", "ru"), ("word and deed", "en")] * 4)]
    model = li.train(frame(spark, data))
    got = li.identify(frame(spark, rows(["ещё", "zzz"])), model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in got] == ["ru", "en"]


def test_odd_rows(spark):
    data = odd_rows()
    got = li.languages(frame(spark, data)).collect()
    assert len(got) == len(data)
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in got)
    assert all(0 <= r.score <= 1 for r in got) and not any(r.held_out for r in got if r.doc_id is None)


def test_nothing_to_learn_from(spark):
    got = li.identify(frame(spark, rows(["some text"])), li.train(frame(spark, []))).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]
    assert li.languages(frame(spark, [])).count() == 0


def test_clashing_names(spark):
    df = frame(spark, rows(["one word here", "un mot ici", None])).withColumn("Score", F.lit("z")).withColumn("SPANS", F.lit("z"))
    got = li.languages(df)
    assert sorted(c for c in got.columns if c.lower() in ("score", "spans", "lang_pred")) == ["lang_pred", "score", "spans"]
    assert got.where("score BETWEEN 0 AND 1").count() == 3
