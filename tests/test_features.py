import math
from collections import Counter

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lexispark.operators.features import FeatureExtractor, extract_features, shapes
from tests.fixtures import sentiment

TEXTS = ["Bu bir örnek metin", "bu metin bir başka örnek örnek", "", "tek", "bu bu bir"]


def brute(texts, lo=1, hi=2, top=None, min_df=1, max_df=1.0):
    """Counts and TF-IDF weights of the vectorizer rules in plain Python."""
    import re

    docs = []
    for t in texts:
        w = re.findall(r"\w{2,}", t.lower())
        docs.append(Counter(" ".join(w[i : i + n]) for n in range(lo, hi + 1) for i in range(len(w) - n + 1)))
    df = Counter(t for d in docs for t in d)
    cf = sum(docs, Counter())
    high = max_df if isinstance(max_df, int) else max_df * len(texts)
    kept = [t for t in df if min_df <= df[t] <= high]
    kept = sorted(sorted(kept, key=lambda t: (-cf[t], t))[:top])
    idf = {t: math.log((1 + len(texts)) / (1 + df[t])) + 1 for t in kept}
    out = {}
    for i, d in enumerate(docs):
        raw = {t: (1 + math.log(d[t])) * idf[t] for t in kept if t in d}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        out.update({(i, kept.index(t), t, d[t]): x / norm for t, x in raw.items()})
    return kept, out


def frame(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")


@pytest.mark.parametrize("options", [{}, {"ngram_range": (1, 3)}, {"max_features": 4}, {"min_df": 2, "max_df": 0.5}, {"max_features": None}])
def test_tfidf_matches_brute_force(spark, options):
    options = {"min_df": 1, "max_df": 1.0, **options}
    extractor = FeatureExtractor(**options)
    rows = extractor.fit_transform(frame(spark)).collect()
    lo, hi = options.get("ngram_range", (1, 2))
    kept, want = brute(TEXTS, lo, hi, options.get("max_features"), options["min_df"], options["max_df"])
    assert [r.term for r in extractor.feature_names().collect()] == kept
    got = {(r.doc_id, r.idx, r.term, r.tf): r.weight for r in rows}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_vectors_agree_with_the_long_table(spark):
    extractor = FeatureExtractor(min_df=1, max_df=1.0).fit(frame(spark))
    dense = {r.doc_id: r.v for r in extractor.vectors(frame(spark)).select("doc_id", vector_to_array("features").alias("v")).collect()}
    assert set(dense) == set(range(5)) and not any(dense[2])  # an empty document keeps a zero row
    for r in extractor.transform(frame(spark)).collect():
        assert dense[r.doc_id][r.idx] == r.weight


def test_unseen_terms_and_count_method(spark):
    train, test, extractor = extract_features(frame(spark), frame(spark, ["bu yeni bir bir"]), "count", (1, 1), None)
    assert {(r.term, r.weight) for r in test.collect()} == {("bu", 1.0), ("bir", 2.0)}
    assert FeatureExtractor("BOTH").method == "both"
    with pytest.raises(ValueError):
        FeatureExtractor("bm25")
    with pytest.raises(ValueError):
        FeatureExtractor(min_df=5, max_df=2)
    with pytest.raises(RuntimeError):
        FeatureExtractor().transform(frame(spark))


def test_save_and_load(spark, tmp_path):
    docs = sentiment(spark)
    extractor = FeatureExtractor("both", (1, 2), 50, 2, 0.9).fit(docs)
    before = sorted(extractor.transform(docs).collect())
    extractor.save(str(tmp_path))
    loaded = FeatureExtractor.load(spark, str(tmp_path))
    assert (loaded.method, loaded.ngram_range, loaded.min_df, loaded.max_df, loaded.max_features) == ("both", (1, 2), 2, 0.9, 50)
    assert sorted(loaded.transform(docs).collect()) == before
    assert {r.split: r.n_features for r in shapes(loaded, docs).collect()}["train"] == loaded.size


def test_document_terms_need_no_exchange(spark):
    docs = frame(spark).repartition(4, "doc_id").withColumn("tokens", F.split("text", " "))
    plan = FeatureExtractor().term_table(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # the repartition above


def test_common_terms_are_found_without_counting_all(spark):
    """Bounds by bucket leave few terms to count, and the vocabulary is that of counting all of them."""
    words = [f"w{i:03d}" for i in range(400)]
    texts = [" ".join(words[(i * i + j * j * (i % 7 + 1)) % (20 if j % 2 else 400)] for j in range(60)) for i in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for size in (15, 40):
        extractor = FeatureExtractor(max_features=size, max_df=0.9)
        counted = extractor.frequent(docs)
        assert size <= counted.count() < extractor.document_frequency(docs).count() / 2
        want = sorted(tuple(r) for r in extractor.ranked_vocabulary(docs).collect())
        assert sorted(tuple(r) for r in extractor.fit(docs).vocabulary.collect()) == want


def test_tokens_may_be_a_string_and_keys_may_repeat(spark):
    """Rows of one key share their norm; tokens of one character or missing ones are no terms; null rows have none."""
    rows = [(1, ["aa", "bb", "aa"]), (1, ["aa"]), (2, ["bb", "c", "aa"]), (None, ["bb"]), (3, None), (4, [])]
    docs = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    extractor = FeatureExtractor(ngram_range=(1, 2), min_df=1, max_df=1.0).fit(docs)
    got = sorted(((r.doc_id or 0, r.term, r.tf, round(r.weight, 9)) for r in extractor.transform(docs).collect()))
    joined = docs.withColumn("tokens", F.array_join("tokens", " "))
    again = FeatureExtractor(ngram_range=(1, 2), min_df=1, max_df=1.0).fit(joined).transform(joined)
    assert sorted(((r.doc_id or 0, r.term, r.tf, round(r.weight, 9)) for r in again.collect())) == got
    squares = {}
    for key, _, _, weight in got:
        squares[key] = squares.get(key, 0) + weight**2
    assert [(k, t, n) for k, t, n, _ in got] == [(0, "bb", 1), (1, "aa", 1), (1, "aa", 2), (1, "aa bb", 1), (1, "bb", 1), (1, "bb aa", 1), (2, "aa", 1), (2, "bb", 1), (2, "bb aa", 1)]
    assert all(abs(s - 1) < 1e-6 for s in squares.values())
