"""Resumed runs: what is taken over, what is made again, and what is refused."""

import pytest
from pyspark.sql import functions as F

from lexispark.config import RunConfig
from lexispark.plans.manifest import Stages, StaleStage, files_digest
from lexispark.plans.run import run
from tests.fixtures import sentiment

ALL = ["loaded_train", "loaded_test", "processed", "feature_extractor", "model_naive_bayes"]


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("manifest")
    for split in ("train", "test"):
        sentiment(spark).where(F.col("split") == split).drop("split").write.parquet(f"{folder}/{split}")
    return folder


def config(base, **more):
    return RunConfig(
        f"{base}/train", f"{base}/test", f"{base}/out", data_format="parquet", label_type="int", models="naive_bayes",
        skip_evaluation=True, skip_statistics=True, **more,
    )


def made(result):
    return [stage for stage, action in result.stages if action == "made"]


def test_resume_makes_what_changed_and_what_follows(spark, base):
    first = run(spark, config(base))
    assert made(first) == ALL
    again = run(spark, config(base, resume=True))
    assert made(again) == [] and [s for s, _ in again.stages] == ALL
    assert again.models["Naive Bayes"].prior == first.models["Naive Bayes"].prior
    assert made(run(spark, config(base, resume=True, model_params={"naive_bayes": {"alpha": 0.5}}))) == ALL[4:]
    assert made(run(spark, config(base, resume=True, max_features=7))) == ALL[3:]
    assert made(run(spark, config(base, resume=True, max_features=7, custom_stopwords=["film"]))) == ALL[2:]
    # other test rows leave what was learned from the training rows
    sentiment(spark).where(F.col("split") == "test").drop("split").limit(3).write.mode("overwrite").parquet(f"{base}/test")
    assert made(run(spark, config(base, resume=True, max_features=7, custom_stopwords=["film"]))) == ["loaded_test", "processed"]


def test_stale_stages_are_refused_or_made_again(spark, base):
    run(spark, config(base))
    skips = {"skip_feature_extraction": True, "skip_model_training": True}
    assert made(run(spark, config(base, **skips))) == ALL[:3]
    with pytest.raises(StaleStage, match="feature_extractor.*clean-up"):
        run(spark, config(base, min_word_length=3, **skips))
    with pytest.raises(StaleStage, match="model_naive_bayes.*extractor"):
        run(spark, config(base, max_features=5, skip_model_training=True))
    redone = run(spark, config(base, min_word_length=3, stale="redo", **skips))
    assert made(redone) == ALL and not redone.failures


def test_unfinished_stages_are_not_taken_over(spark, tmp_path):
    stages = Stages(spark, str(tmp_path), resume=True)
    with pytest.raises(StaleStage, match="never finished"):
        stages.reuse("x", {"a": "1"}, {}, skip=True)
    assert stages.reuse("x", {"a": "1"}, {"s": 1}) is None
    mark = stages.commit("x", {"a": "1"}, {"s": 1})
    assert stages.reuse("x", {"a": "1"}, {"s": 1}) == mark
    assert stages.reuse("x", {"a": "1"}, {"s": 2}) is None  # from here on it is being written
    assert stages.read("x") is None and stages.reuse("x", {"a": "1"}, {"s": 1}) is None
    with pytest.raises(ValueError, match="stale"):
        Stages(spark, "x", stale="ignore")


def test_files_digest_sees_sizes_and_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x")
    one = files_digest(spark, str(tmp_path))
    assert files_digest(spark, str(tmp_path)) == one
    (tmp_path / "b.csv").write_text("y")
    assert files_digest(spark, str(tmp_path)) != one
