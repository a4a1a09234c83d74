import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lexispark.operators import classifiers as cl
from lexispark.operators import metrics as mt
from lexispark.operators import selection as sel
from lexispark.operators.features import FeatureExtractor
from lexispark.operators.labels import class_sizes
from lexispark.operators.naive_bayes import NaiveBayes, fit_naive_bayes
from lexispark.operators.projection import project
from tests.fixtures import sentiment


@pytest.fixture(scope="module")
def corpus(spark):
    docs = sentiment(spark)
    extractor = FeatureExtractor(min_df=1).fit(docs)
    return docs, extractor, extractor.transform(docs, ["label"]).cache(), extractor.vectors(docs, ["label"]).cache()


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


@pytest.mark.parametrize("variant", ["multinomial", "complement"])
@pytest.mark.parametrize("alpha,fit_prior", [(1.0, True), (0.3, False)])
def test_naive_bayes_matches_brute_force(corpus, variant, alpha, fit_prior):
    docs, extractor, long, vectors = corpus
    model = fit_naive_bayes(long, docs, extractor.size, variant=variant, alpha=alpha, fit_prior=fit_prior)
    data = vectors.select("doc_id", "label", vector_to_array("features").alias("v")).collect()
    x, y = np.array([r.v for r in data]), np.array([r.label for r in data])
    n = np.array([x[y == c].sum(0) for c in (0, 1)])
    if variant == "multinomial":
        logp = np.log(n + alpha) - np.log((n + alpha).sum(1, keepdims=True))
        prior = np.log([np.mean(y == c) if fit_prior else 0.5 for c in (0, 1)])
    else:
        rest = n.sum(0) + alpha - n
        logp, prior = -np.log(rest / rest.sum(1, keepdims=True)), np.zeros(2)
    joint = x @ logp.T + prior
    want = np.exp(joint - joint.max(1, keepdims=True))
    want /= want.sum(1, keepdims=True)
    got = {r.doc_id: r for r in model.predict(long, docs).collect()}
    for r, p in zip(data, want):
        assert np.allclose(got[r.doc_id].probability, p)
        assert got[r.doc_id].prediction == int(p.argmax())


def test_naive_bayes_reload(spark, corpus, tmp_path):
    docs, extractor, long, _ = corpus
    model = fit_naive_bayes(long, docs, extractor.size)
    before = rows(model.predict(long, docs), "doc_id", "prediction", "probability")
    model.save(str(tmp_path))
    loaded = NaiveBayes.load(spark, str(tmp_path))
    assert rows(loaded.predict(long, docs), "doc_id", "prediction", "probability") == before
    assert loaded.get_params() == {"variant": "multinomial", "alpha": 1.0, "fit_prior": True}
    with pytest.raises(ValueError):
        NaiveBayes("gaussian")


PARAMETERS = {
    "decision_tree": [{"criterion": "entropy", "max_depth": 5}, {"max_features": "sqrt", "class_weight": "balanced"}],
    "maxent": [{}, {"penalty": "l1", "C": 10.0}],
    "svm": [{}, {"probability": False}],
    "random_forest": [{"n_estimators": 10, "min_samples_split": 5}],
}


@pytest.mark.parametrize("name,params", [(n, p) for n, ps in PARAMETERS.items() for p in ps])
def test_classifier_invariants(spark, corpus, tmp_path, name, params):
    docs, extractor, _, vectors = corpus
    model = cl.CLASSIFIERS[name](**params).fit(vectors)
    scored = model.predict(vectors)
    assert mt.summary(scored).first().accuracy > 0.8
    if "probability" in scored.columns:
        for r in scored.collect():
            assert abs(sum(r.probability) - 1) < 1e-9 and min(r.probability) >= 0
    else:
        with pytest.raises(RuntimeError):
            model.predict_proba(vectors)
    importance = model.feature_importance(spark, extractor.vocabulary)
    assert importance.count() == extractor.size
    if name in ("decision_tree", "random_forest"):
        assert abs(importance.agg(F.sum("importance")).first()[0] - 1) < 1e-6
        assert importance.where("importance < 0").count() == 0
    assert model.feature_importance(spark).where("term like 'feature_%'").count() == extractor.size
    before = rows(scored, "doc_id", "prediction")
    model.save(str(tmp_path))
    loaded = cl.load_classifier(spark, str(tmp_path))
    assert rows(loaded.predict(vectors), "doc_id", "prediction") == before
    assert loaded.get_params() == model.get_params()


def test_classifier_errors(spark, tmp_path):
    for bad in (
        lambda: cl.LinearSVM(variant="kernel"),
        lambda: cl.LinearSVM(loss="logistic"),
        lambda: cl.LinearSVM(loss="hinge", penalty="l1"),
        lambda: cl.DecisionTree(criterion="log"),
        lambda: cl.RandomForest(max_depth=31),
        lambda: cl.MaxEnt(solver="saga"),
    ):
        with pytest.raises(ValueError):
            bad()
    with pytest.raises(FileNotFoundError):
        cl.load_classifier(spark, str(tmp_path / "none"))


def noisy(spark, n=300):
    rng = random.Random(5)
    data = []
    for i in range(n):
        x = [rng.random() for _ in range(4)]
        data.append((i, "abc"[int(x[0] * 2 + x[1] + rng.random() * 0.6) % 3], Vectors.dense(x)))
    return spark.createDataFrame(data, ["doc_id", "label", "features"]).cache()


def test_min_samples_split_cuts_small_nodes(spark):
    data = noisy(spark)
    free = cl.DecisionTree(max_depth=10).fit(data)
    cut = cl.DecisionTree(max_depth=10, min_samples_split=20).fit(data)
    inner = cut.nodes(spark).where("threshold is not null")
    assert inner.where("n < 20").count() == 0 and cut.n_leaves() < free.n_leaves()
    kept = free.nodes(spark).where("threshold is not null and n >= 20")
    shared = ["term", "threshold", "n"]
    # the kept splits are those of the free tree
    assert rows(inner, *shared) == rows(kept, *shared)
    leaves = cut.nodes(spark).where("threshold is null")
    assert leaves.count() == cut.n_leaves() and leaves.agg(F.sum("n")).first()[0] == 300


def test_multiclass_svm_and_maxent_importances(spark):
    data = noisy(spark)
    svm = cl.LinearSVM(max_iter=10).fit(data)
    assert len(svm.models) == 15
    for model in (svm, cl.MaxEnt().fit(data)):
        assert {r["class"] for r in model.feature_importance(spark).select("class").distinct().collect()} == {"Class_a", "Class_b", "Class_c"}
        assert all(abs(sum(r.probability) - 1) < 1e-9 for r in model.predict(data).collect())


def test_grid_search_and_curve(spark):
    data = noisy(spark)
    folds = sel.stratified_folds(data.select("doc_id", "label"), 3)
    folded = data.join(folds.select("doc_id", "fold"), "doc_id").cache()
    grid = sel.parameter_grid({"max_depth": [1, 4], "criterion": ["gini", "entropy"]}, lambda p: p != {"max_depth": 1, "criterion": "gini"})
    assert len(grid) == 3
    model, report = sel.grid_search(cl.DecisionTree, folded, grid, 3, validation=data)
    assert report["cv_results"].count() == 9 and report["best_params"] in grid
    means = {r.point: r.m for r in report["cv_results"].groupBy("point").agg(F.avg("f1").alias("m")).collect()}
    assert abs(max(means.values()) - report["best_score"]) < 1e-9
    assert model.get_params()["max_depth"] == report["best_params"]["max_depth"]
    one_class = folded.withColumn("label", F.when(F.col("doc_id") < 150, "a").otherwise(F.col("label")))
    first = {r.train_f1 for r in sel.learning_curve(cl.DecisionTree, one_class, (0.3,), 3).collect()}
    assert None in first  # the first rows of some folds are all of one class
    curve = sel.learning_curve(lambda: cl.DecisionTree(max_depth=3), folded, (0.5, 1.0), 3)
    assert curve.count() == 6 and curve.where("train_f1 between 0 and 1 and test_f1 between 0 and 1").count() == 6


# Folds and samples -------------------------------------------------------------------------------------


@pytest.mark.parametrize("k", [2, 5])
def test_folds_match_brute_force(spark, k):
    rng = random.Random(k)
    labels = [rng.choice("aaaaab") if rng.random() < 0.9 else "c" for _ in range(203)]
    df = spark.createDataFrame(list(enumerate(labels)), "doc_id int, label string")
    got = {r.doc_id: r.fold for r in sel.stratified_folds(df, k).collect()}
    order = list(dict.fromkeys(labels))
    codes = sorted(order.index(x) for x in labels)
    for c, name in enumerate(order):
        quota = [codes[f::k].count(c) for f in range(k)]
        want = [f for f in range(k) for _ in range(quota[f])]
        assert [got[i] for i, x in enumerate(labels) if x == name] == want
    with pytest.raises(ValueError):
        sel.stratified_folds(df.limit(3), 5)


def test_sample_is_exact_and_proportional(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 7, "x").when(F.col("id") % 10 < 9, "y").otherwise("z").alias("label"))
    sample = sel.stratified_sample(df, 333)
    counts = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    assert counts == {"x": 233, "y": 67, "z": 33}
    assert rows(sel.stratified_sample(df, 333), "doc_id") == rows(sample, "doc_id")
    assert rows(sel.stratified_sample(df, 333, seed=1), "doc_id") != rows(sample, "doc_id")
    assert sel.stratified_sample(df, 6000).count() == 5000


def test_class_weights(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, "b")], "doc_id int, label string")
    assert {r.label: r.class_weight for r in sel.with_class_weights(df).collect()} == {"a": 4 / 6, "b": 2.0}


# Evaluation ----------------------------------------------------------------------------------------------


def scores_frame(spark, rows_):
    return spark.createDataFrame(rows_, "doc_id int, label int, prediction int, probability array<double>")


def test_curves_match_brute_force(spark):
    rng = random.Random(3)
    data = [(i, rng.randint(0, 1), 0, round(rng.random(), 1)) for i in range(200)]
    df = scores_frame(spark, [(i, y, p, [1 - s, s]) for i, y, p, s in data])
    scores = mt.class_scores(df, [0, 1])
    pos = [s for _, y, _, s in data if y == 1]
    neg = [s for _, y, _, s in data if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(mt.roc_auc(scores).first().roc_auc - want) < 1e-9
    every = mt.roc_points(scores, drop_intermediate=False).collect()
    assert len(every) == len({s for *_, s in data}) + 1
    assert (max(r.fpr for r in every), max(r.tpr for r in every)) == (1.0, 1.0)
    bends = rows(mt.roc_points(scores), "fpr", "tpr")
    assert set(bends) <= {(r.fpr, r.tpr) for r in every} and (0.0, 0.0) in bends and (1.0, 1.0) in bends
    ap, before = 0.0, 0.0
    for t in sorted({s for *_, s in data}, reverse=True):
        tp, fp = sum(p >= t for p in pos), sum(n >= t for n in neg)
        ap += (tp / len(pos) - before) * tp / (tp + fp)
        before = tp / len(pos)
    assert abs(mt.average_precision(scores).first().average_precision - ap) < 1e-9


def test_straight_runs_are_left_out(spark):
    # two negatives in a row lie on one horizontal line
    df = scores_frame(spark, [(1, 1, 1, [0.1, 0.9]), (2, 0, 1, [0.2, 0.8]), (3, 0, 1, [0.3, 0.7]), (4, 1, 0, [0.6, 0.4])])
    points = rows(mt.roc_points(mt.class_scores(df, [0, 1])), "fpr", "tpr")
    assert points == [(0.0, 0.0), (0.0, 0.5), (1.0, 0.5), (1.0, 1.0)]


def test_undefined_area_is_null(spark):
    one_class = scores_frame(spark, [(1, 1, 1, [0.1, 0.9]), (2, 1, 0, [0.6, 0.4])])
    assert mt.model_auc(mt.class_scores(one_class, [0, 1])).first().roc_auc is None


def test_report_with_a_class_never_predicted(spark):
    df = scores_frame(spark, [(1, 0, 0, None), (2, 0, 1, None), (3, 1, 1, None), (4, 2, 1, None)])
    report = {r.label: r for r in mt.class_report(df).collect()}
    assert (report["0"].precision, report["0"].recall) == (1.0, 0.5)
    assert (report["2"].precision, report["2"].f1_score, report["2"].support) == (0.0, 0.0, 1)
    assert report["accuracy"].f1_score == 0.5 and report["macro avg"].support == 4
    matrix = {(r.label, r.prediction): (r.n, r.share) for r in mt.confusion_matrix(df).collect()}
    assert len(matrix) == 9 and matrix[2, 1] == (1, 1.0) and matrix[1, 2] == (0, 0.0)
    wide = {r.label: (r["0"], r["1"], r["2"]) for r in mt.wide_confusion(mt.confusion_matrix(df), [0, 1, 2]).collect()}
    assert wide[0] == (1, 1, 0)


def test_comparison_without_probabilities(spark):
    df = scores_frame(spark, [(1, 0, 0, None), (2, 1, 1, None)]).withColumn("model", F.lit("m"))
    timings = spark.createDataFrame([("m", None, 0.5)], "model string, training_time double, prediction_time double")
    table = mt.compare_models(df, [0, 1], timings)
    assert table.first()["ROC AUC"] is None and table.first()["Accuracy"] == 1.0
    assert table.columns == list(mt.COMPARISON_COLUMNS.values())
    assert {r.Metric for r in mt.long_metrics(table).collect()} == {"Accuracy", "Precision", "Recall", "F1 Score"}
    assert {(r.Metric, r["Time (s)"]) for r in mt.long_timings(table).collect()} == {("Training Time (s)", 0.0), ("Prediction Time (s)", 0.5)}


# Projection ------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("method,k", [("pca", 2), ("svd", 3)])
def test_projection_matches_numpy(corpus, method, k):
    docs, extractor, long, vectors = corpus
    data = sorted(vectors.select("doc_id", vector_to_array("features").alias("v")).collect())
    x = np.array([r.v for r in data])
    if method == "pca":
        x = x - x.mean(0)
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    want = np.abs((u * s)[:, :k])
    out = project(long, docs.select("doc_id", "label"), vectors, method, k).orderBy("doc_id").collect()
    got = np.abs([[r[f"c{i + 1}"] for i in range(k)] for r in out])
    # components with well separated singular values
    for i in range(k):
        if s[i] - s[i + 1] > 0.05 and (i == 0 or s[i - 1] - s[i] > 0.05):
            assert np.allclose(got[:, i], want[:, i], atol=1e-6)
    with pytest.raises(ValueError):
        project(long, docs, vectors, method, 4)
    with pytest.raises(ValueError):
        project(long, docs, vectors, "tsne")
