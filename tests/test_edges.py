"""Cases that the given tables don't hold."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexispark.config import RunConfig
from lexispark.operators import corpus_stats as cs
from lexispark.operators import selection as sel
from lexispark.operators.features import FeatureExtractor
from lexispark.operators.labels import class_sizes
from lexispark.operators.naive_bayes import NaiveBayes
from lexispark.operators.tokens import lemmatize
from lexispark.plans.run import run
from lexispark.sources import artifacts

TEXTS = [
    ("aa bb", "x"), ("aa bb bb", "x"), ("bb cc", "y"), ("cc cc dd", "y"), ("aa dd", "x"), ("dd ee", "y"), ("ee aa", "x"), ("cc ee", "y"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, c) for i, (t, c) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, label string")


def tokens(df):
    return df.withColumn("tokens", F.split("text", " "))


def test_one_lemma_a_token(spark):
    df = spark.createDataFrame([(1, ["evler", "su", "evler"])], "doc_id bigint, tokens array<string>")
    lemmas = [("evler", "evle", 2), ("evler", "ev", 3), ("evler", "konut", 1), ("evler", None, 0)]
    table = spark.createDataFrame(lemmas, "token string, lemma string, rank int")
    assert lemmatize(df, table.drop("rank")).first().tokens == ["ev", "su", "ev"]
    assert lemmatize(df, table).first().tokens == ["konut", "su", "konut"]


def test_one_character_tokens_are_no_terms(spark):
    df = spark.createDataFrame([(1, ["a", "bc", "x", "de"], "a bc x de")], "doc_id bigint, tokens array<string>, text string")
    extractor = FeatureExtractor("count", min_df=1, max_df=1.0)
    ready = {r.term: r.tf for r in extractor.term_table(df).collect()}
    assert ready == {r.term: r.tf for r in extractor.term_table(df.drop("tokens")).collect()} == {"bc": 1, "de": 1, "bc de": 1}


def test_vocabulary_errors(docs):
    with pytest.raises(ValueError, match="no term"):
        FeatureExtractor("count", min_df=100, max_df=200).fit(tokens(docs))
    with pytest.raises(ValueError, match="below"):
        FeatureExtractor(min_df=0.9, max_df=0.5)


@pytest.mark.parametrize("variant", ["multinomial", "complement"])
def test_terms_without_a_training_row_are_smoothed(docs, variant):
    extractor = FeatureExtractor("count", (1, 1), min_df=1, max_df=1.0).fit(tokens(docs))
    some = tokens(docs).where("doc_id < 3")
    model = NaiveBayes(variant).fit(extractor.transform(some, ["label"]), class_sizes(some), extractor.size)
    scored = model.predict(extractor.transform(tokens(docs)), tokens(docs)).collect()
    words = sorted({w for t, _ in TEXTS for w in t.split()})
    n = {c: Counter(w for t, k in TEXTS[:3] if k == c for w in t.split()) for c in "xy"}
    total = sum(n.values(), Counter())

    def value(word, c):
        if variant == "multinomial":
            return math.log((n[c][word] + 1) / (sum(n[c].values()) + len(words)))
        rest = total[word] - n[c][word]
        return -math.log((rest + 1) / (sum(total.values()) - sum(n[c].values()) + len(words)))

    prior = {"x": math.log(2 / 3), "y": math.log(1 / 3)} if variant == "multinomial" else {"x": 0.0, "y": 0.0}
    for r in scored:
        joint = {c: prior[c] + sum(value(w, c) for w in TEXTS[r.doc_id][0].split()) for c in "xy"}
        assert abs(r.probability[0] - 1 / (1 + math.exp(joint["y"] - joint["x"]))) < 1e-9


def test_ties_go_to_the_first_point_of_the_grid(spark):
    rows = [(a, p, f, 0.5) for a in (1.0, 0.1) for p in (False, True) for f in (0, 1)]
    results = spark.createDataFrame(rows, "alpha double, fit_prior boolean, fold int, f1 double")
    best = sel.best_point(results, ["alpha", "fit_prior"]).first()
    assert (best.alpha, best.fit_prior) == (0.1, True)
    best = sel.best_point(results, ["alpha", "fit_prior"], {"alpha": [1.0, 0.1], "fit_prior": [False, True]}).first()
    assert (best.alpha, best.fit_prior) == (1.0, False)


def test_density_without_spread_has_no_rows(spark):
    df = spark.createDataFrame([(1, "a b", "s"), (2, "c d", "s"), (3, "a", "t"), (4, "a b", "u"), (5, "a b c", "u")], "doc_id bigint, text string, split string")
    assert {r.split for r in cs.length_density(df, by=["split"]).collect()} == {"u"}
    assert cs.length_density(df.where("split = 't'")).count() == 0


def test_a_second_search_replaces_the_first(spark, tmp_path):
    rows = spark.createDataFrame([(0, 0.5, "a"), (1, 0.6, "a")], "fold int, f1 double, model string")
    other = rows.withColumn("model", F.lit("b"))
    for df in (rows, other, rows):
        artifacts.save_search(df, str(tmp_path))
    found = spark.read.parquet(f"{tmp_path}/cv_results").groupBy("model").count().collect()
    assert {r.model: r["count"] for r in found} == {"a": 2, "b": 2}


def test_complement_search_and_curve_in_a_run(spark, docs, tmp_path):
    many = docs.crossJoin(spark.range(4).select(F.col("id").alias("copy"))).select((F.col("doc_id") * 10 + F.col("copy")).alias("doc_id"), "text", "label")
    for split in ("train", "test"):
        many.write.parquet(f"{tmp_path}/{split}")
    cfg = RunConfig(
        f"{tmp_path}/train", f"{tmp_path}/test", f"{tmp_path}/out", data_format="parquet", models="naive_bayes", optimize=True, cv=2,
        model_params={"naive_bayes": {"variant": "complement"}}, language="english", curve_sample=None,
    )
    result = run(spark, cfg)
    assert not result.failures and result.models["Naive Bayes"].variant == "complement"
    assert result.tables["learning_curve"].count() > 0
    assert {r.split for r in result.tables["split_sizes"].collect()} == {"train", "test"}
