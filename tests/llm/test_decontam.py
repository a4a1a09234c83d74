import random
import re

from lexispark.llm.decontam import build_index, contamination, phrase_matches, proximity_matches

from .helpers import LONG, fold, frame, odd_rows, rows


def split(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", fold(text))


def brute(data, items, size=10):
    out = []
    for r in data:
        w, hit, ids = split(r[1]), set(), set()
        for item, text in items:
            q = split(text)
            n = min(len(q), size)
            for k in range(len(q) - n + 1 if q else 0):
                for i in range(len(w) - n + 1):
                    if w[i : i + n] == q[k : k + n]:
                        hit |= set(range(i, i + n))
                        ids.add(str(item))
        out.append((r[0], len(w), len(hit), sorted(ids), bool(hit)))
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    random.seed(5)
    some = lambda n: " ".join(random.choice("the of and a to in over Under x1 é") for _ in range(n))
    passage = "Alpha beta, gamma; delta Epsilon zeta eta theta iota kappa lambda mu nu"
    items = [(1, passage), (2, "Short item here"), (30, None), (4, ""), (5, "!?"), (6, LONG[:200]), (7, passage), (8, "word")]
    texts = [some(300).replace(" ", random.choice([" ", ", "]), 3) for _ in range(30)]
    texts += [some(40) + " " + passage.upper() + " " + some(9), "alpha beta gamma delta epsilon zeta eta theta iota", "a SHORT item  here? short item here", passage + " " + passage]
    data = odd_rows() + rows(texts, 50)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = contamination(frame(spark, data), bench)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in got.collect()), key=str)
    assert got == brute(data, items)


def test_phrases_do_not_cross_documents(spark):
    data = rows(["one two three four five", "six seven eight nine ten"])
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id bigint, text string")
    assert all(not r.runs for r in phrase_matches(build_index(frame(spark, data)), items).collect())


def test_query_blocks_give_the_same(spark, monkeypatch):
    from lexispark.llm import decontam

    data = rows([f"start {i} the quick brown fox number {i} jumps over that lazy dog today" for i in range(12)])
    items = [(i, f"the quick brown fox number {i} jumps over that lazy dog today") for i in range(12)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(decontam, "QUERY_BLOCK", 100)
    got = contamination(frame(spark, data), bench)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in got.collect()), key=str) == brute(data, items)


def test_proximity(spark):
    data = rows(["red x green y blue", "blue green and some other words then red", "blue red green", "red green", None])
    items = spark.createDataFrame([(1, "red green blue"), (2, "absent"), (3, None)], "item_id bigint, text string")
    got = proximity_matches(build_index(frame(spark, data)), items, slop=2).collect()
    assert sorted((r.item_id, r.doc_id, r.first, r.last) for r in got) == [("1", 0, 0, 4), ("1", 2, 0, 2)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert contamination(frame(spark, []), none).count() == 0
    assert [r.n_hit for r in contamination(frame(spark, rows(["a b"])), none).collect()] == [0]
