import pytest
from pyspark.sql import functions as F

from lexispark.config import RunConfig
from lexispark.plans.run import run
from tests.fixtures import sentiment


@pytest.fixture(scope="module")
def paths(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("run")
    docs = sentiment(spark)
    for split in ("train", "test"):
        docs.where(F.col("split") == split).drop("split").write.parquet(f"{base}/{split}")
    return {"train_path": f"{base}/train", "test_path": f"{base}/test", "results_dir": f"{base}/out", "data_format": "parquet", "label_type": "int"}


def test_whole_run_and_resume(spark, paths):
    cfg = RunConfig(
        **paths,
        models="naive_bayes, decision_tree",
        optimize=True,
        cv=2,
        search_grids={"decision_tree": {"max_depth": [2, 3]}},
    )
    result = run(spark, cfg)
    assert not result.failures and set(result.models) == {"Naive Bayes", "Decision Tree"}
    comparison = {r.Model: r for r in result.tables["comparison"].collect()}
    assert comparison["Naive Bayes"]["F1 Score"] == 1.0 and comparison["Naive Bayes"]["Training Time (s)"] > 0
    assert result.tables["learning_curve"].groupBy("model").count().count() == 2
    assert result.tables["best_model"].count() == 1 and result.tables["roc_points"].count() > 0
    summary = result.tables["run_summary"].first()
    assert (summary.train_size, summary.test_size, summary.n_classes) == (21, 5, 2)
    searched = spark.read.parquet(f"{paths['results_dir']}/metrics/cv_results")
    assert {r.model: r["count"] for r in searched.groupBy("model").count().collect()} == {"naive_bayes": 20, "decision_tree": 4}
    csv = spark.read.option("header", True).csv(f"{paths['results_dir']}/metrics/model_comparison.csv")
    assert csv.count() == 2
    # later stages from the saved ones
    again = run(spark, RunConfig(**paths, models="naive_bayes,decision_tree", skip_feature_extraction=True, skip_model_training=True, learning_curves=False, skip_statistics=True))
    same = {r.Model: r["F1 Score"] for r in again.tables["comparison"].collect()}
    assert same == {m: r["F1 Score"] for m, r in comparison.items()}


def test_failing_model_does_not_stop_the_others(spark, paths):
    cfg = RunConfig(
        **{**paths, "results_dir": paths["results_dir"] + "2"},
        models="maxent,naive_bayes",
        model_params={"maxent": {"penalty": "l7"}},
        skip_statistics=True,
        learning_curves=False,
        skip_preprocessing=True,
    )
    result = run(spark, cfg)
    assert "l7" in result.failures["Maxent"] and list(result.models) == ["Naive Bayes"]


def test_unknown_model():
    with pytest.raises(ValueError, match="xgb"):
        RunConfig("a", "b", "c", models="xgb").model_names()
