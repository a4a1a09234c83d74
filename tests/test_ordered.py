import random

import pytest
from pyspark.sql import functions as F

from lexispark.operators import dictionary
from lexispark.operators.dictionary import TokenDictionary
from lexispark.operators.lookup import lookup_join
from lexispark.operators.ordered import row_numbers, running_sums
from lexispark.operators.tokens import drop_listed, lemmatize


@pytest.mark.parametrize("n_ranges", [2, 7, 300])
def test_running_sums_match_brute_force(spark, n_ranges):
    rng = random.Random(n_ranges)
    # one group holds most rows
    rows = [("hot" if rng.random() < 0.8 else rng.choice("abc"), i, rng.randint(0, 5)) for i in range(800)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, o bigint, v bigint")
    out = running_sums(df, ["g"], "o", {"s": F.col("v")}, n_ranges, totals=True, following={"nxt": "v"})
    got = {(r.g, r.o): (r.s, r.s_total, r.nxt) for r in out.collect()}
    want = {}
    for g in {r[0] for r in rows}:
        part = sorted((o, v) for h, o, v in rows if h == g)
        total, acc = sum(v for _, v in part), 0
        for i, (o, v) in enumerate(part):
            acc += v
            want[g, o] = (acc, total, part[i + 1][1] if i + 1 < len(part) else None)
    assert got == want


def test_row_numbers_of_strings_and_empty_input(spark):
    words = [f"w{i % 97}x{i}" for i in range(500)]
    df = spark.createDataFrame([(0, w) for w in words], "g int, w string")
    got = {r.w: r.rank for r in row_numbers(df, ["g"], "w").collect()}
    assert got == {w: i + 1 for i, w in enumerate(sorted(words))}
    assert row_numbers(df.where("g > 0"), ["g"], "w").count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_salted_lookup_equals_broadcast(spark, how):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "the").otherwise(F.concat(F.lit("w"), F.col("id") % 50)).alias("token"))
    lookup = spark.createDataFrame([("the", 1)] + [(f"w{i}", i) for i in range(0, 40)], "token string, idx int")
    small = lookup_join(rows, lookup, "token", how)
    large = lookup_join(rows, lookup, "token", how, limit=3, salts=5)
    columns = small.columns
    assert sorted(map(tuple, small.collect()), key=str) == sorted(map(tuple, large.select(columns).collect()), key=str)
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    ranked = lookup_join(rows, lookup.withColumn("n", F.when(F.col("token") == "the", 2000).otherwise(F.col("idx"))), "token", how, limit=3, rank_by="n")
    assert sorted(map(tuple, small.collect()), key=str) == sorted(map(tuple, ranked.select(columns).collect()), key=str)
    # wide rows count with all their numbers
    wide = lookup_join(rows, lookup, ["token"], how, max_rows=41, width=10_000_000, salts=5)
    assert "BroadcastHashJoin" not in wide._jdf.queryExecution().executedPlan().toString()


def test_token_tables(spark):
    docs = spark.createDataFrame([(1, ["a", "B", "c", "a"], "x"), (2, [], "y"), (3, ["b"], "z")], "doc_id int, tokens array<string>, k string")
    words = spark.createDataFrame([("b",), ("b",), ("q",)], "word string")
    lemmas = spark.createDataFrame([("a", "A1"), ("zz", "z")], "token string, lemma string")
    for known in (None, TokenDictionary.fit(docs, head=2), TokenDictionary.fit(docs, head=0)):
        got = {r.doc_id: (r.k, r.tokens) for r in drop_listed(docs, words, dictionary=known).collect()}
        assert got == {1: ("x", ["a", "c", "a"]), 2: ("y", []), 3: ("z", [])}
        got = {r.doc_id: r.tokens for r in lemmatize(docs, lemmas, dictionary=known).collect()}
        assert got == {1: ["A1", "B", "c", "A1"], 2: [], 3: ["b"]}


@pytest.mark.parametrize("limit", [0, 200_000])
@pytest.mark.parametrize("head", [0, 5, 1000])
def test_dictionary_equals_plain_lookups(spark, monkeypatch, head, limit):
    monkeypatch.setattr(dictionary, "MAX_BROADCAST_ROWS", limit)
    rng = random.Random(4)
    # one word is a third of all tokens
    lists = [["the" if rng.random() < 0.33 else f"W{rng.randint(0, 120)}" for _ in range(rng.randint(0, 40))] for _ in range(80)]
    rows = [(i, t, i % 3) for i, t in enumerate(lists)] + [(90, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, tokens array<string>, label int")
    known = TokenDictionary.fit(docs, head=head)
    table = {r.term: (r.id, r.n) for r in known.table.collect()}
    words = {t for x in lists for t in x}
    assert sorted(i for i, _ in table.values()) == list(range(len(words))) and set(table) == words
    counts = {w: sum(x.count(w) for x in lists) for w in words}
    assert {w: n for w, (_, n) in table.items()} == counts
    first = sorted(words, key=lambda w: (-counts[w], w))[:head]
    assert [table[w][0] for w in first] == list(range(len(first)))
    coded = known.encode(docs)
    assert coded.columns == ["doc_id", "label", "tokens"]
    assert {r.doc_id: r.tokens for r in coded.collect()} == {i: [table[t][0] for t in x or []] for i, x, _ in rows}
    assert {r.doc_id: r.tokens for r in known.decode(coded).collect()} == {i: x or [] for i, x, _ in rows}
    listed = spark.createDataFrame([("the",), ("w7",), ("w8",), (None,)], "word string")
    kept = {r.doc_id: r.tokens for r in drop_listed(docs, listed, dictionary=known).collect()}
    assert kept == {i: [t for t in x or [] if t.lower() not in ("the", "w7", "w8")] for i, x, _ in rows}
    lemmas = {"the": "W1", "W2": "new", "W3": "newer", "W4": "the"}
    got = {r.doc_id: r.tokens for r in lemmatize(docs, spark.createDataFrame(list(lemmas.items()), "token string, lemma string"), dictionary=known).collect()}
    assert got == {i: [lemmas.get(t, t) for t in x or []] for i, x, _ in rows}
    other = spark.createDataFrame([(1, ["the", "never", "W5"])], "doc_id bigint, tokens array<string>")
    assert known.encode(other).first().tokens == [table["the"][0], dictionary.UNKNOWN, table["W5"][0]]


def test_short_lists_are_dropped_inside_the_row(spark, monkeypatch):
    """Nothing is shuffled for a short list (before: a dictionary of all tokens), and a long one gives the same."""
    docs = spark.createDataFrame([(1, ["Ab", "cd", None, "ef"]), (1, ["cd"]), (2, None), (3, [])], "doc_id bigint, tokens array<string>")
    words = spark.createDataFrame([("ab",), ("ef",), ("ef",), (None,), ("Cd",)], "word string")
    kept = drop_listed(docs, words)
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
    found = sorted(kept.collect(), key=str)
    assert [r.tokens for r in found if r.doc_id == 1] == [["cd", None], ["cd"]]
    monkeypatch.setattr("lexispark.operators.tokens.SHORT_LIST", 2)
    assert sorted(drop_listed(docs, words).collect(), key=str) == found
