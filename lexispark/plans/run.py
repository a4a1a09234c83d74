"""A whole run: load, clean, extract features, train, evaluate, describe.

Every stage writes its result under ``results_dir`` and the next stage reads it from there, so
a stage that is skipped, or that would come out the same, is taken from an earlier run. Manifests (see ``manifest``) tell
which stored stages belong to the inputs and settings at hand.
"""

from __future__ import annotations

import time
import traceback
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import MODEL_TITLES, RunConfig
from ..functions import text as tx
from ..functions.stopwords import load_stopwords
from ..operators import corpus_stats as cs
from ..operators import metrics as mt
from ..operators import selection as sel
from ..operators.classifiers import CLASSIFIERS, RUN_PARAMETERS, SEARCH_GRIDS, load_classifier
from ..operators.features import FeatureExtractor
from ..operators.labels import ClassSize, class_sizes
from ..operators.naive_bayes import NaiveBayes
from ..operators.tokens import lemmatize
from ..session import cached
from ..sources import artifacts, corpus
from .manifest import Stages, StaleStage, digest, files_digest, table_digest

NB_PARAMETERS = ["alpha", "fit_prior"]


@dataclass
class Features:
    """What the models of a run are trained and scored on."""

    extractor: FeatureExtractor
    train: DataFrame
    test: DataFrame
    sizes: list[ClassSize]
    fingerprint: str = ""
    _vectors: dict = field(default_factory=dict)

    def long(self, split: str, keep=()) -> DataFrame:
        return self.extractor.transform(getattr(self, split), list(keep))

    def vectors(self, split: str) -> DataFrame:
        """ML vectors of a split, cached at first use (they are read from a written table)."""
        if split not in self._vectors:
            self._vectors[split] = cached(self.extractor.vectors(getattr(self, split), ["label"]))
        return self._vectors[split]

    def release(self) -> None:
        for df in self._vectors.values():
            df.unpersist()


@dataclass
class RunResult:
    models: dict = field(default_factory=dict)
    failures: dict = field(default_factory=dict)
    tables: dict = field(default_factory=dict)
    stages: list = field(default_factory=list)
    """Stages in order, and whether each was made or taken over."""
    seconds: float = 0.0


def run(spark: SparkSession, cfg: RunConfig) -> RunResult:
    start = time.time()
    names = cfg.model_names()
    result = RunResult()
    stages = Stages(spark, cfg.results_dir, cfg.resume, cfg.stale)
    result.stages = stages.actions
    (train, test), loaded = load(spark, cfg, stages)
    docs, cleaned = preprocess(spark, cfg, train, test, stages, loaded)
    features = extract(spark, cfg, docs, stages, {"training table": loaded["train"], "clean-up": cleaned})
    try:
        train_models(spark, cfg, names, features, result, stages)
        if not cfg.skip_evaluation and result.models:
            evaluate(spark, cfg, features, result)
        if not cfg.skip_statistics:
            describe(cfg, corpus.union_splits(train, test), docs, features, result)
    finally:
        features.release()
    result.seconds = time.time() - start
    return result


# Stages ---------------------------------------------------------------------------------------------


def load(spark: SparkSession, cfg: RunConfig, stages: Stages) -> tuple[tuple[DataFrame, DataFrame], dict[str, str]]:
    """Both splits with columns ``doc_id, text, label`` (and ``dataset``), checked for their columns, and their fingerprints."""
    out, marks = [], {}
    for split, path in (("train", cfg.train_path), ("test", cfg.test_path)):
        stage, folder = f"loaded_{split}", f"{cfg.results_dir}/loaded"
        made_from = {"input": files_digest(spark, path)}
        settings = {k: getattr(cfg, k) for k in ("text_column", "label_column", "data_format", "multi_line", "label_type")}
        marks[split] = stages.reuse(stage, made_from, settings)
        if marks[split]:
            out.append(spark.read.parquet(f"{folder}/{split}"))
            continue
        df = corpus.read_corpus(
            spark, path, split, cfg.text_column, cfg.label_column, fmt=cfg.data_format, multi_line=cfg.multi_line
        )
        columns = ["doc_id", "split"] + (["dataset"] if "dataset" in df.columns else [])
        text, label = F.col(cfg.text_column).alias("text"), F.col(cfg.label_column).cast(cfg.label_type).alias("label")
        # generated keys depend on how a scan is cut, so the keyed rows are written once
        out.append(artifacts.save_table(df.select(*columns, text, label), folder, split))
        marks[split] = stages.commit(stage, made_from, settings)
    return tuple(out), marks


def preprocess(
    spark: SparkSession, cfg: RunConfig, train: DataFrame, test: DataFrame, stages: Stages, loaded: dict[str, str]
) -> tuple[DataFrame, str]:
    """Both splits with the text the features are built from (raw texts when the stage is skipped), and a digest of how it was made."""
    docs = corpus.union_splits(train, test)
    if cfg.skip_preprocessing:
        return docs, digest("raw texts")
    stop = load_stopwords(cfg.language, cfg.custom_stopwords, fold=cfg.fold_stopwords)
    lemmas = spark.read.parquet(cfg.lemma_path) if cfg.lemma_path else None
    settings = {"stop-words": sorted(stop), "least length": cfg.min_word_length, "lemmas": table_digest(lemmas) if lemmas else None}
    cleaned, made_from = digest(settings), {"training table": loaded["train"], "test table": loaded["test"]}
    if stages.reuse("processed", made_from, settings):
        return spark.read.parquet(f"{cfg.results_dir}/processed/documents"), cleaned
    docs = docs.withColumn("tokens", tx.clean_tokens(F.col("text"), stop, cfg.min_word_length))
    if lemmas is not None:
        docs = lemmatize(docs, lemmas)
    docs = docs.withColumn("processed_text", F.array_join("tokens", " "))
    docs = artifacts.save_table(docs.drop("text"), f"{cfg.results_dir}/processed", "documents")
    stages.commit("processed", made_from, settings)
    return docs, cleaned


def extract(spark: SparkSession, cfg: RunConfig, docs: DataFrame, stages: Stages, made_from: dict[str, str]) -> Features:
    path = f"{cfg.results_dir}/models/feature_extractor"
    columns = ["doc_id", "label"] + (["text"] if cfg.skip_preprocessing else ["tokens"])
    train, test = (docs.where(F.col("split") == s).select(*columns) for s in ("train", "test"))
    settings = {"method": cfg.feature_method, "n-grams": list(cfg.ngram_range), "terms": cfg.max_features}
    mark = stages.reuse("feature_extractor", made_from, settings, cfg.skip_feature_extraction)
    if mark:
        extractor = FeatureExtractor.load(spark, path)
    else:
        extractor = FeatureExtractor(cfg.feature_method, cfg.ngram_range, cfg.max_features).fit(train)
        extractor.save(path)
        mark = stages.commit("feature_extractor", made_from, settings)
    return Features(extractor, train, test, class_sizes(train), mark)


def train_models(spark: SparkSession, cfg: RunConfig, names: list[str], features: Features, result: RunResult, stages: Stages) -> None:
    """Fit (or search, or load) every model; one that fails is recorded and the others go on. A stale model ends the run."""
    made_from = {"extractor": features.fingerprint}
    for name in names:
        path = f"{cfg.results_dir}/models/{name}"
        search = [cfg.cv, cfg.search_grids.get(name)] if cfg.optimize else None
        settings = {"parameters": cfg.model_params.get(name, {}), "search": search}
        try:
            if stages.reuse(f"model_{name}", made_from, settings, cfg.skip_model_training):
                model = NaiveBayes.load(spark, path) if name == "naive_bayes" else load_classifier(spark, path)
            else:
                model = _fit(spark, cfg, name, features)
                model.save(path)
                stages.commit(f"model_{name}", made_from, settings)
            result.models[MODEL_TITLES[name]] = model
        except StaleStage:
            raise
        except Exception:  # the other models still run
            result.failures[MODEL_TITLES[name]] = traceback.format_exc()


def _fit(spark: SparkSession, cfg: RunConfig, name: str, features: Features):
    if name == "naive_bayes":
        long = features.long("train", ["label"])
        params = cfg.model_params.get(name, {})
        if cfg.optimize:
            folds = sel.stratified_folds(features.train.select("doc_id", "label"), cfg.cv, sizes=features.sizes)
            size = features.extractor.size
            scores = sel.naive_bayes_grid(
                long, folds, size, features.sizes, params.get("variant", "multinomial"), cfg.search_grids.get(name), cfg.cv, max_features=size
            )
            scores = cached(scores)
            best = sel.best_point(scores, NB_PARAMETERS, cfg.search_grids.get(name)).first()
            params = {**params, "alpha": best.alpha, "fit_prior": best.fit_prior}
            table = scores.select(
                F.create_map(
                    F.lit("alpha"), F.col("alpha").cast("string"), F.lit("fit_prior"), F.col("fit_prior").cast("string")
                ).alias("params"),
                "fold",
                "f1",
                F.lit(name).alias("model"),
            )
            artifacts.save_search(table, f"{cfg.results_dir}/metrics")
            scores.unpersist()
        return NaiveBayes(**params).fit(long, features.sizes, features.extractor.size)
    kind = CLASSIFIERS[name]
    params = {**RUN_PARAMETERS[name], **cfg.model_params.get(name, {})}
    vectors = features.vectors("train")
    if not cfg.optimize:
        return kind(**params).fit(vectors)
    folds = sel.stratified_folds(features.train.select("doc_id", "label"), cfg.cv, sizes=features.sizes)
    folded = cached(vectors.join(folds.select("doc_id", "fold"), "doc_id"))
    grid = sel.parameter_grid(cfg.search_grids.get(name, SEARCH_GRIDS[name]), kind.valid)
    model, report = sel.grid_search(kind, folded, grid, cfg.cv, cfg.parallelism)
    table = report["cv_results"].select("params", "fold", "f1", F.lit(name).alias("model"))
    artifacts.save_search(table, f"{cfg.results_dir}/metrics")
    folded.unpersist()
    return model


def evaluate(spark: SparkSession, cfg: RunConfig, features: Features, result: RunResult) -> None:
    """Score the test split with every model and derive all evaluation tables from the scored rows."""
    folder = f"{cfg.results_dir}/metrics"
    classes = [c.label for c in features.sizes]
    parts, times, importances = [], [], []
    names = features.extractor.vocabulary.select("idx", "term")
    for title, model in result.models.items():
        start = time.time()
        if isinstance(model, NaiveBayes):
            scored = model.predict(features.long("test"), features.test)
        else:
            scored = model.predict(features.vectors("test"))
            importances.append(model.feature_importance(spark, names).withColumn("model", F.lit(title)))
        if "probability" not in scored.columns:
            scored = scored.withColumn("probability", F.lit(None).cast("array<double>"))
        columns = ["doc_id", "label", "prediction", "probability"]
        slug = title.lower().replace(" ", "_")
        parts.append(artifacts.save_table(scored.select(*columns, F.lit(title).alias("model")), f"{folder}/scored", slug))
        model.prediction_time = time.time() - start
        times.append((title, float(model.training_time), float(model.prediction_time)))
    scored = corpus.union_splits(*parts)
    timings = spark.createDataFrame(times, "model string, training_time double, prediction_time double")
    comparison = artifacts.save_table(mt.compare_models(scored, classes, F.broadcast(timings)), folder, "comparison")
    artifacts.save_csv(comparison, f"{folder}/model_comparison.csv")
    reports = [mt.class_report(p).withColumn("model", F.lit(t)) for t, p in zip(result.models, parts)]
    with_area = scored.where(F.col("probability").isNotNull())
    tables = {
        "confusion": mt.confusion_matrix(scored, ["model"]),
        "class_report": corpus.union_splits(*reports),
        "best_model": mt.best_model(comparison),
        "long_metrics": mt.long_metrics(comparison),
        "long_timings": mt.long_timings(comparison),
        "metric_matrix": mt.metric_matrix(comparison),
    }
    if len(classes) == 2:
        tables["roc_points"] = mt.roc_points(mt.class_scores(with_area, classes, ["model"]), ["model"])
    curve_scores = mt.class_scores(with_area, classes, ["model"])
    tables["pr_points"] = mt.pr_points(curve_scores, ["model"])
    tables["average_precision"] = mt.average_precision(curve_scores, ["model"])
    if importances:
        tables["top_importances"] = mt.top_importances(corpus.union_splits(*importances))
    if cfg.learning_curves:
        tables["learning_curve"] = learning_curves(cfg, features, result)
        tables["learning_curve_summary"] = mt.learning_curve_summary(tables["learning_curve"])
    result.tables.update(comparison=comparison, **artifacts.save_results(tables, folder))


def learning_curves(cfg: RunConfig, features: Features, result: RunResult) -> DataFrame:
    """Learning curves of the run's models on a stratified sample of the training rows."""
    keys = features.train.select("doc_id", "label")
    sample = keys if cfg.curve_sample is None else sel.stratified_sample(keys, cfg.curve_sample, sizes=features.sizes)
    folds = sel.stratified_folds(sample, cfg.cv)
    curves = []
    for title, model in result.models.items():
        if isinstance(model, NaiveBayes):
            long = features.long("train", ["label"]).join(folds.select("doc_id"), "doc_id", "left_semi")
            size = features.extractor.size
            curve = sel.naive_bayes_curve(
                long, folds, size, alpha=model.alpha, fit_prior=model.fit_prior, k=cfg.cv, max_features=size, variant=model.variant
            )
        else:
            vectors = cached(features.vectors("train").join(folds.select("doc_id", "fold"), "doc_id"))
            curve = sel.learning_curve(lambda m=model: type(m)(**m.get_params()), vectors, k=cfg.cv, parallelism=cfg.parallelism)
            vectors.unpersist()
        curves.append(curve.withColumn("model", F.lit(title)))
    return corpus.union_splits(*curves)


def describe(cfg: RunConfig, raw: DataFrame, docs: DataFrame, features: Features, result: RunResult) -> None:
    """Corpus statistics and the run summary."""
    long, train = features.long("train"), docs.where(F.col("split") == "train")
    n_docs = F.lit(sum(c.n for c in features.sizes))
    tables = {
        "split_sizes": corpus.split_sizes(raw),
        "label_counts": corpus.value_counts(raw, "label"),
        "missing_texts": corpus.missing_texts(raw),
        "label_distribution": cs.label_distribution(docs),
        "length_stats": cs.length_stats(raw, ["split"]),
        "length_histogram": cs.length_histogram(raw, by=["split"]),
        "length_density": cs.length_density(raw, by=["split"]),
        "feature_means": cs.feature_means(long, n_docs, 20),
        "feature_correlation": cs.feature_correlation(long, n_docs),
        "run_summary": mt.run_summary(docs, features.extractor.size),
    }
    if "processed_text" in docs.columns:
        tables["word_frequency"] = cs.word_frequency(train)
        tables["word_frequency_by_class"] = cs.word_frequency_by_class(train)
    datasets = corpus.dataset_counts(raw)
    if datasets is not None:
        tables["dataset_counts"] = datasets
    result.tables.update(artifacts.save_results(tables, f"{cfg.results_dir}/statistics"))
