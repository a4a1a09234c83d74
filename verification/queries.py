"""Every operator as a query over the given tables: ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

import uuid
from functools import cached_property, lru_cache

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.config import RunConfig
from lexispark.functions import text as tx
from lexispark.functions.stopwords import load_stopwords
from lexispark.operators import corpus_stats as cs
from lexispark.operators import metrics as mt
from lexispark.operators import selection as sel
from lexispark.operators.classifiers import CLASSIFIERS, RUN_PARAMETERS, SEARCH_GRIDS
from lexispark.operators.cleanup import processed
from lexispark.operators.exact_tree import ExactTree
from lexispark.operators.features import FeatureExtractor, gram_totals, shapes
from lexispark.operators.labels import balanced_weights, class_sizes, class_table
from lexispark.operators.naive_bayes import NaiveBayes
from lexispark.operators.projection import project
from lexispark.operators.tokens import drop_listed, lemmatize
from lexispark.plans.run import run
from lexispark.session import cached, ensure_checkpoint_dir, written
from lexispark.sources import corpus as io

# Fixed value: the depth of a tree in a run without a search.
EXACT_DEPTH = RUN_PARAMETERS["decision_tree"]["max_depth"]


@lru_cache(maxsize=1)
def stop_list() -> tuple[str, ...]:
    return tuple(load_stopwords("english"))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, with no negative zero, so that two engines print them alike."""

    def tidy(name: str) -> Column:
        value = F.round(F.col(f"`{name}`"), digits)
        return F.when(value == 0, F.lit(0.0)).otherwise(value).alias(name)

    return df.select(*[tidy(f.name) if f.dataType.typeName() == "double" else F.col(f"`{f.name}`") for f in df.schema])


# Corpora -------------------------------------------------------------------------------------------


def documents(spark: SparkSession, folder: str, label: str = "lang") -> DataFrame:
    """All documents with a class label, the data set they come from and their split."""
    columns = list(dict.fromkeys(["doc_id", "text", "source", label]))
    df = io.read_table(spark, folder, "documents", columns, "doc_id")
    return df.select("doc_id", "text", F.col(label).alias("label"), F.col("source").alias("dataset"), io.key_split().alias("split"))


def rated(spark: SparkSession, folder: str, label: str = "quality") -> DataFrame:
    """Documents that carry a binary label."""
    df = io.read_table(spark, folder, "documents", ["doc_id", "text", "source"], "doc_id")
    labels = io.read_table(spark, folder, "labels", ["doc_id", F.col(label).alias("label")])
    return df.join(labels, "doc_id").select("doc_id", "text", "label", F.col("source").alias("dataset"), io.key_split().alias("split"))


def clean(docs: DataFrame) -> DataFrame:
    """Documents with their kept tokens instead of the raw text."""
    return docs.withColumn("tokens", tx.clean_tokens(F.col("text"), stop_list())).drop("text")


def cleaned(docs: DataFrame) -> DataFrame:
    """``clean``, written once for queries that read the tokens several times: a string with blanks between them."""
    return written(processed(docs, stop_list()), "tokens")


def part(docs: DataFrame, split: str) -> DataFrame:
    return docs.where(F.col("split") == split)


def fitted(docs: DataFrame, **options) -> FeatureExtractor:
    return FeatureExtractor(**options).fit(part(docs, "train"))


class Bayes:
    """A fitted Naive Bayes with the pieces the queries look at."""

    def __init__(self, docs: DataFrame, **params):
        self.docs = cleaned(docs)
        self.extractor = fitted(self.docs)
        self.sizes = class_sizes(part(docs, "train"))
        self.classes = [c.label for c in self.sizes]
        self.train = self.extractor.transform(part(self.docs, "train"), ["label"])
        self.test = self.extractor.transform(part(self.docs, "test"))
        self.params = params

    @cached_property
    def model(self) -> NaiveBayes:
        """Fitted at first use: searches and curves need none."""
        return self.fit(**self.params)

    def fit(self, **params) -> NaiveBayes:
        return NaiveBayes(**params).fit(self.train, self.sizes, self.extractor.size)

    def scored(self, model: NaiveBayes | None = None) -> DataFrame:
        return (model or self.model).predict(self.test, part(self.docs, "test"))

    def scores(self) -> DataFrame:
        return mt.class_scores(self.scored(), self.classes)


def folded(b: Bayes) -> tuple[DataFrame, DataFrame]:
    """Training documents with folds, and their long features."""
    train = part(b.docs, "train").select("doc_id", "label")
    return sel.stratified_folds(train, sizes=b.sizes), b.train


QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = lambda spark, folder: rounded(fn(spark, folder))
    return fn


# Loading -------------------------------------------------------------------------------------------


@query
def corpus_sizes(spark, folder):
    return io.split_sizes(documents(spark, folder))


@query
def corpus_label_counts(spark, folder):
    return io.value_counts(documents(spark, folder), "label")


@query
def corpus_dataset_counts(spark, folder):
    return io.dataset_counts(documents(spark, folder))


@query
def dataset_label_crosstab(spark, folder):
    docs = documents(spark, folder)
    return io.crosstab(docs, "dataset", "label", [c.label for c in class_sizes(docs)])


@query
def missing_text_counts(spark, folder):
    return io.missing_texts(documents(spark, folder))


@query
def texts_and_labels(spark, folder):
    return io.texts_and_labels(rated(spark, folder))


def scratch(spark, name):
    """A fresh folder in the shared one."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@query
def csv_corpus_roundtrip(spark, folder):
    """Processed splits written as CSV, read in ranges and checked for their columns."""
    docs = documents(spark, folder).withColumn("processed_text", tx.process_text(F.col("text"), stop_list()))
    out = scratch(spark, "corpus")
    io.save_processed(part(docs, "train"), part(docs, "test"), out)
    back = io.load_processed(spark, out, docs.drop("split").schema)
    for df, split in zip(back, ("train", "test"), strict=True):
        io.require_columns(df, ("text", "label", "processed_text"), split)
    return io.union_splits(*back)


# Text ----------------------------------------------------------------------------------------------


def pages(spark, folder):
    return io.read_table(spark, folder, "pages", ["page_id", "html"], "page_id")


def step(docs, key, text, fn):
    return docs.select(key, fn(F.col(text)).alias("result"))


@query
def lower_documents(spark, folder):
    return step(documents(spark, folder), "doc_id", "text", tx.lower_text)


@query
def fold_documents(spark, folder):
    return step(documents(spark, folder), "doc_id", "text", lambda c: tx.fold_unicode(tx.lower_text(c)))


@query
def remove_urls_pages(spark, folder):
    return step(pages(spark, folder), "page_id", "html", tx.remove_urls)


@query
def remove_tags_pages(spark, folder):
    return step(pages(spark, folder), "page_id", "html", tx.remove_tags)


@query
def remove_punctuation_pages(spark, folder):
    return step(pages(spark, folder), "page_id", "html", tx.remove_punctuation)


@query
def remove_digits_pages(spark, folder):
    return step(pages(spark, folder), "page_id", "html", tx.remove_digits)


@query
def collapse_blanks_documents(spark, folder):
    return step(documents(spark, folder), "doc_id", "text", tx.collapse_blanks)


@query
def normalize_documents(spark, folder):
    return step(documents(spark, folder), "doc_id", "text", tx.normalize)


@query
def normalize_pages(spark, folder):
    return step(pages(spark, folder), "page_id", "html", tx.normalize)


@query
def normalize_conversations(spark, folder):
    rows = io.read_table(spark, folder, "conversations", ["conv_id", "turn", "text"], "conv_id")
    return rows.select("conv_id", "turn", tx.normalize(F.col("text")).alias("result"))


@query
def tokens(spark, folder):
    rows = pages(spark, folder)
    return rows.select("page_id", F.posexplode(tx.tokenize(F.col("html"))).alias("pos", "token"))


@query
def min_length_filter(spark, folder):
    kept = lambda c: F.array_join(tx.drop_short(tx.tokenize(tx.normalize(c)), 4), " ")
    return step(documents(spark, folder), "doc_id", "text", kept)


@query
def stopword_filter(spark, folder):
    kept = lambda c: F.array_join(tx.drop_stopwords(tx.tokenize(c), stop_list()), " ")
    return step(documents(spark, folder), "doc_id", "text", kept)


@query
def stopword_filter_by_code(spark, folder):
    """The list is named by a language code in capitals."""
    kept = lambda c: F.array_join(tx.drop_stopwords(tx.tokenize(c), tuple(load_stopwords("EN"))), " ")
    return step(documents(spark, folder), "doc_id", "text", kept)


def benchmark_words(spark, folder):
    rows = io.read_table(spark, folder, "benchmark", ["item_id", "text"], "item_id")
    return rows.select(F.explode(tx.tokenize(tx.normalize(F.col("text")))).alias("word")).distinct()


@query
def custom_stopword_antijoin(spark, folder):
    words = benchmark_words(spark, folder).where(F.length("word") <= 3)
    kept = drop_listed(clean(documents(spark, folder)), words)
    return kept.select("doc_id", F.array_join("tokens", " ").alias("result"))


@query
def lemma_lookup(spark, folder):
    words = benchmark_words(spark, folder).where(F.length("word") >= 5).where(F.col("word").endswith("ing"))
    lemmas = words.select(F.col("word").alias("token"), F.expr("left(word, length(word) - 3)").alias("lemma"))
    kept = lemmatize(clean(documents(spark, folder)), lemmas)
    return kept.select("doc_id", F.array_join("tokens", " ").alias("result"))


@query
def processed_text(spark, folder):
    return step(documents(spark, folder), "doc_id", "text", lambda c: tx.process_text(c, stop_list()))


@query
def processed_samples(spark, folder):
    train = part(documents(spark, folder), "train").orderBy("doc_id").limit(3)
    return train.select("doc_id", "text", tx.process_text(F.col("text"), stop_list()).alias("processed_text"))


# Features ------------------------------------------------------------------------------------------


@query
def ngrams_up_to_three(spark, folder):
    return gram_totals(clean(documents(spark, folder)), F.col("tokens"), 1, 3).select("term", F.col("cf").alias("n"))


@query
def term_counts(spark, folder):
    return FeatureExtractor().term_table(clean(documents(spark, folder)))


@query
def raw_text_term_counts(spark, folder):
    """The vectorizer's own tokens, for texts that skip the clean-up."""
    return FeatureExtractor(ngram_range=(1, 1)).term_table(documents(spark, folder))


@query
def document_frequency(spark, folder):
    docs = part(clean(documents(spark, folder)), "train")
    return FeatureExtractor(min_df=0.002, max_df=0.5).pruned(docs).select("term", "df", "cf")


def vocabulary(spark, folder, **options):
    return FeatureExtractor(**options).ranked_vocabulary(part(clean(documents(spark, folder)), "train"))


@query
def vocabulary_topk(spark, folder):
    return vocabulary(spark, folder).select("term", "idx", "df", "cf")


@query
def full_vocabulary(spark, folder):
    return vocabulary(spark, folder, max_features=None).select("term", "idx", "df", "cf")


@query
def idf(spark, folder):
    return vocabulary(spark, folder).select("idx", "idf")


@query
def feature_names(spark, folder):
    return fitted(clean(documents(spark, folder))).feature_names()


def transformed(spark, folder, split, **options):
    docs = cleaned(documents(spark, folder))
    return fitted(docs, **options).transform(part(docs, split))


@query
def tfidf_weights(spark, folder):
    return transformed(spark, folder, "train").select("doc_id", "idx", "weight")


@query
def tfidf_transform_test(spark, folder):
    return transformed(spark, folder, "test").select("doc_id", "idx", "term", "weight")


@query
def count_features(spark, folder):
    return transformed(spark, folder, "test", method="count").select("doc_id", "idx", "weight")


@query
def both_features(spark, folder):
    return transformed(spark, folder, "test", method="both").select("doc_id", "idx", "tf", "weight")


@query
def unbounded_tfidf(spark, folder):
    """No vocabulary limit: the lookup is not broadcast unless its size allows it."""
    return transformed(spark, folder, "test", max_features=None).select("doc_id", "idx", "weight")


@query
def feature_shapes(spark, folder):
    docs = clean(documents(spark, folder))
    return shapes(fitted(docs), docs)


# Naive Bayes -----------------------------------------------------------------------------------------


@query
def nb_multinomial_model(spark, folder):
    return Bayes(documents(spark, folder)).model.log_probabilities()


@query
def nb_uniform_prior(spark, folder):
    return predictions(Bayes(rated(spark, folder), fit_prior=False))


@query
def nb_complement_model(spark, folder):
    return Bayes(documents(spark, folder), variant="complement").model.log_probabilities()


def predictions(b: Bayes) -> DataFrame:
    return b.scored().select("doc_id", "label", "prediction")


@query
def nb_predict(spark, folder):
    return predictions(Bayes(documents(spark, folder, "source")))


@query
def resumed_run(spark, folder):
    """Predictions of a run that stopped after training and was resumed: texts, extractor and model come from its files."""
    ensure_checkpoint_dir(spark)
    base = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/run-{uuid.uuid4().hex}"
    docs = documents(spark, folder, "source").select("doc_id", "text", "label", "split")
    for split in ("train", "test"):
        part(docs, split).drop("split").write.parquet(f"{base}/{split}")
    options = {"data_format": "parquet", "language": "english", "models": "naive_bayes", "learning_curves": False, "skip_statistics": True}
    run(spark, RunConfig(f"{base}/train", f"{base}/test", f"{base}/out", **options, skip_evaluation=True))
    resumed = run(spark, RunConfig(f"{base}/train", f"{base}/test", f"{base}/out", **options, resume=True))
    if resumed.failures or any(action != "taken over" for _, action in resumed.stages):
        raise RuntimeError(f"stages were not taken over: {resumed.stages} {resumed.failures}")
    return spark.read.parquet(f"{base}/out/metrics/scored/naive_bayes").select("doc_id", "label", "prediction")


@query
def nb_complement_predict(spark, folder):
    return predictions(Bayes(documents(spark, folder, "source"), variant="complement"))


@query
def nb_predict_proba(spark, folder):
    b = Bayes(documents(spark, folder, "source"))
    entries = F.explode(F.arrays_zip(F.array(*map(F.lit, b.classes)).alias("class"), "probability")).alias("e")
    return b.scored().select("doc_id", entries).select("doc_id", "e.class", "e.probability")


@query
def nb_grid_search(spark, folder):
    b = Bayes(rated(spark, folder))
    docs, features = folded(b)
    return sel.naive_bayes_grid(
        features, docs, b.extractor.size, b.sizes, max_features=b.extractor.size
    )


@query
def nb_best_parameters(spark, folder):
    return sel.best_point(nb_grid_search(spark, folder), ["alpha", "fit_prior"])


@query
def nb_holdout_report(spark, folder):
    """The best point of the search, and how its model does on the test split."""
    b = Bayes(rated(spark, folder))
    docs, features = folded(b)
    results = sel.naive_bayes_grid(features, docs, b.extractor.size, b.sizes, max_features=b.extractor.size)
    return sel.tuned_naive_bayes(results, b.train, b.sizes, b.extractor.size, (b.test, part(b.docs, "test")))[1]


@query
def nb_learning_curve(spark, folder):
    b = Bayes(rated(spark, folder))
    docs, features = folded(b)
    return sel.naive_bayes_curve(
        features, docs, b.extractor.size, b.sizes, max_features=b.extractor.size
    )


@query
def learning_curve_summary(spark, folder):
    curve = nb_learning_curve(spark, folder).withColumn("model", F.lit("Naive Bayes"))
    return mt.learning_curve_summary(curve)


# Folds, samples, weights -------------------------------------------------------------------------------


@query
def balanced_class_weights(spark, folder):
    docs = documents(spark, folder)
    rows = list(balanced_weights(class_sizes(docs)).items())
    return class_table(docs, rows, "label string, class_weight double")


@query
def class_weighted_documents(spark, folder):
    return sel.with_class_weights(documents(spark, folder).select("doc_id", "label"))


@query
def stratified_folds(spark, folder):
    return sel.stratified_folds(documents(spark, folder).select("doc_id", "label"))


@query
def stratified_sample(spark, folder):
    docs = documents(spark, folder, "source").select("doc_id", "label")
    return sel.stratified_sample(docs, 777)


@query
def random_split(spark, folder):
    return io.random_split(documents(spark, folder).select("doc_id", "label"), test_share=0.25, seed=7)


# Evaluation ------------------------------------------------------------------------------------------


def source_model(spark, folder):
    return Bayes(documents(spark, folder, "source"))


@query
def metrics_summary(spark, folder):
    return mt.summary(Bayes(rated(spark, folder)).scored())


@query
def class_report(spark, folder):
    return mt.class_report(source_model(spark, folder).scored())


@query
def confusion_matrix(spark, folder):
    return mt.confusion_matrix(source_model(spark, folder).scored()).select("label", "prediction", "n")


@query
def confusion_normalized(spark, folder):
    return mt.confusion_matrix(source_model(spark, folder).scored()).select("label", "prediction", "share")


@query
def confusion_wide(spark, folder):
    b = Bayes(documents(spark, folder))
    return mt.wide_confusion(mt.confusion_matrix(b.scored()), b.classes)


@query
def roc_points(spark, folder):
    return mt.roc_points(Bayes(rated(spark, folder)).scores()).select("threshold", "fpr", "tpr")


@query
def roc_points_all(spark, folder):
    points = mt.roc_points(Bayes(rated(spark, folder)).scores(), drop_intermediate=False)
    return points.select("threshold", "fpr", "tpr")


@query
def roc_auc(spark, folder):
    return mt.roc_auc(Bayes(rated(spark, folder)).scores()).select("roc_auc")


@query
def ovr_auc(spark, folder):
    return mt.model_auc(source_model(spark, folder).scores())


@query
def ovr_auc_per_class(spark, folder):
    return mt.roc_auc(source_model(spark, folder).scores())


@query
def pr_points(spark, folder):
    return mt.pr_points(Bayes(rated(spark, folder)).scores()).select("threshold", "precision", "recall")


@query
def pr_points_multiclass(spark, folder):
    return mt.pr_points(source_model(spark, folder).scores())


@query
def average_precision(spark, folder):
    return mt.average_precision(source_model(spark, folder).scores())


NAIVE_BAYES_MODELS = {
    "Multinomial": {},
    "Uniform prior": {"fit_prior": False},
    "Complement": {"variant": "complement"},
}


@query
def model_comparison(spark, folder):
    b = Bayes(rated(spark, folder))
    scored = [b.scored(b.fit(**params)).withColumn("model", F.lit(name)) for name, params in NAIVE_BAYES_MODELS.items()]
    return mt.compare_models(io.union_splits(*scored), b.classes).drop("Training Time (s)", "Prediction Time (s)")


@query
def comparison_without_probability(spark, folder):
    """Models that give labels only have no area; the others keep theirs."""
    b = Bayes(rated(spark, folder))
    multinomial, complement = b.scored(), b.scored(b.fit(variant="complement")).drop("probability")
    scored = (multinomial.withColumn("model", F.lit("Multinomial")), complement.withColumn("model", F.lit("Complement")))
    return mt.compare_models(io.union_splits(*scored), b.classes).drop("Training Time (s)", "Prediction Time (s)")


@query
def timings_unpivot(spark, folder):
    """Which times each model has: the times themselves differ from run to run."""
    b = Bayes(rated(spark, folder))
    scored, times = [], []
    for name, params in NAIVE_BAYES_MODELS.items():
        model = b.fit(**params)
        scored.append(model.timed_predict(b.test, part(b.docs, "test")).withColumn("model", F.lit(name)))
        times.append((name, model.training_time, model.prediction_time))
    timings = spark.createDataFrame(times, "model string, training_time double, prediction_time double")
    table = mt.long_timings(mt.compare_models(io.union_splits(*scored), b.classes, timings))
    return table.select("Model", "Metric", (F.col("Time (s)") > 0).alias("measured"))


@query
def best_model(spark, folder):
    return mt.best_model(model_comparison(spark, folder)).select("Model", "F1 Score")


@query
def metrics_unpivot(spark, folder):
    return mt.long_metrics(model_comparison(spark, folder))


@query
def metric_matrix(spark, folder):
    return mt.metric_matrix(model_comparison(spark, folder))


@query
def top_importances(spark, folder):
    model = Bayes(documents(spark, folder)).model
    table = model.log_probabilities().select(
        F.lit("Naive Bayes").alias("model"), F.col("label").alias("class"), "term", F.round("logp", 9).alias("importance")
    )
    return mt.top_importances(table, 20)


@query
def run_summary(spark, folder):
    docs = clean(documents(spark, folder))
    return mt.run_summary(docs, fitted(docs).size)


# Corpus statistics -------------------------------------------------------------------------------------


@query
def label_distribution(spark, folder):
    return cs.label_distribution(documents(spark, folder))


@query
def doc_length_stats(spark, folder):
    return cs.length_stats(documents(spark, folder), ["split"])


@query
def doc_length_histogram(spark, folder):
    return cs.length_histogram(documents(spark, folder), by=["split"])


@query
def doc_length_density(spark, folder):
    return rounded(cs.length_density(documents(spark, folder), by=["split"]), 9)


@query
def word_frequency(spark, folder):
    docs = documents(spark, folder).withColumn("processed_text", tx.process_text(F.col("text"), stop_list()))
    return cs.word_frequency(docs, 20)


@query
def word_counts(spark, folder):
    """All words of the raw text but the listed ones."""
    return cs.word_counts(documents(spark, folder), "text", stopwords=stop_list())


@query
def word_frequency_by_class(spark, folder):
    docs = documents(spark, folder).withColumn("processed_text", tx.process_text(F.col("text"), stop_list()))
    return cs.word_frequency_by_class(docs, 10)


def train_features(spark, folder):
    docs = part(cleaned(documents(spark, folder)), "train")
    return FeatureExtractor().fit(docs).transform(docs), docs.agg(F.count("*").alias("n")).scalar()


@query
def feature_means(spark, folder):
    return cs.feature_means(*train_features(spark, folder), 20)


@query
def most_variable_features(spark, folder):
    return cs.most_variable(*train_features(spark, folder)).select("term", "std_weight")


@query
def feature_correlation(spark, folder):
    return cs.feature_correlation(*train_features(spark, folder))


@query
def feature_correlation_lower(spark, folder):
    return cs.feature_correlation(*train_features(spark, folder), lower_only=True)


# Spark ML models: iterative fits, checked by invariants in the tests ---------------------------------------


def vectors(spark, folder):
    """Training and test vectors of the rated documents, as written tables."""
    docs = cleaned(rated(spark, folder))
    extractor = fitted(docs)
    return extractor, *(extractor.vectors(part(docs, s), ["label"]) for s in ("train", "test"))


def scored_by(spark, folder, name):
    _, train, test = vectors(spark, folder)
    model = CLASSIFIERS[name](**RUN_PARAMETERS[name]).fit(train)
    return model.predict(test).select("doc_id", "label", "prediction", F.col("probability")[1].alias("probability"))


@query
def ml_vectors(spark, folder):
    _, train, _ = vectors(spark, folder)
    entries = vector_to_array("features")
    return train.select("doc_id", "label", F.size(F.filter(entries, lambda x: x != 0)).alias("n_terms"))


@query
def ml_vector_entries(spark, folder):
    """The vectors that the models are given, entry by entry."""
    _, train, test = vectors(spark, folder)
    v = F.unwrap_udt("features")
    entry = F.explode(F.arrays_zip(v["indices"].alias("idx"), v["values"].alias("weight"))).alias("e")
    return train.unionByName(test).select("doc_id", "label", entry).select("doc_id", "label", "e.idx", "e.weight")


@query
def decision_tree(spark, folder):
    return scored_by(spark, folder, "decision_tree")


@query
def tree_nodes(spark, folder):
    extractor, train, _ = vectors(spark, folder)
    return CLASSIFIERS["decision_tree"](**RUN_PARAMETERS["decision_tree"]).fit(train).nodes(spark, extractor.vocabulary)


def exact_tree(spark, folder):
    """A tree with exact thresholds on the rated training documents, and what it is asked with."""
    docs = cleaned(rated(spark, folder))
    extractor = fitted(docs)
    train, test = part(docs, "train"), part(docs, "test")
    tree = ExactTree("entropy", EXACT_DEPTH, 5).fit(extractor.transform(train), train.select("doc_id", "label"))
    return tree, extractor, test


@query
def exact_tree_nodes(spark, folder):
    tree, extractor, _ = exact_tree(spark, folder)
    return tree.nodes(extractor.vocabulary)


@query
def exact_tree_predict(spark, folder):
    tree, extractor, test = exact_tree(spark, folder)
    scored = tree.predict(extractor.transform(test), test.select("doc_id", "label"))
    return scored.select("doc_id", "label", "prediction", F.col("probability")[1].alias("probability"))


@query
def exact_tree_importances(spark, folder):
    tree, extractor, _ = exact_tree(spark, folder)
    return tree.importances().join(extractor.vocabulary.select("idx", "term"), "idx").select("term", "importance")


@query
def maxent(spark, folder):
    return scored_by(spark, folder, "maxent")


@query
def maxent_coefficients(spark, folder):
    extractor, train, _ = vectors(spark, folder)
    model = CLASSIFIERS["maxent"](**RUN_PARAMETERS["maxent"]).fit(train)
    table = model.feature_importance(spark, extractor.vocabulary).withColumn("model", F.lit("Maxent"))
    return mt.top_importances(table)


@query
def linear_svm_calibrated(spark, folder):
    return scored_by(spark, folder, "svm")


@query
def random_forest(spark, folder):
    return scored_by(spark, folder, "random_forest")


@query
def forest_importances(spark, folder):
    extractor, train, _ = vectors(spark, folder)
    model = CLASSIFIERS["random_forest"](**RUN_PARAMETERS["random_forest"]).fit(train)
    table = model.feature_importance(spark, extractor.vocabulary).withColumn("model", F.lit("Random Forest"))
    return mt.top_importances(table)


@query
def grid_search_ml(spark, folder):
    """Search over the whole tree grid."""
    _, train, _ = vectors(spark, folder)
    folds = sel.stratified_folds(train.select("doc_id", "label"))
    rows = cached(train.join(folds.select("doc_id", "fold"), "doc_id"))
    grid = sel.parameter_grid(SEARCH_GRIDS["decision_tree"])
    _, report = sel.grid_search(CLASSIFIERS["decision_tree"], rows, grid)
    return report["cv_results"].select(
        F.array_join(F.transform(F.map_entries("params"), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("params"),
        "fold",
        "f1",
    )


def linear_search(spark, folder, name):
    """All points of a linear model's grid on all folds, with the iterations and the optimality residual of each."""
    _, train, _ = vectors(spark, folder)
    folds = sel.stratified_folds(train.select("doc_id", "label"))
    kind = CLASSIFIERS[name]
    grid = sel.parameter_grid(SEARCH_GRIDS[name], kind.valid)
    scores = sel.lockstep_scores(kind, train.join(folds.select("doc_id", "fold"), "doc_id"), grid, 5)
    rows = [(",".join(f"{n}={v}" for n, v in sorted(grid[r["point"]].items())), r["fold"], r["f1"], r["iterations"], r["residual"]) for r in scores]
    return spark.createDataFrame(rows, "params string, fold int, f1 double, iterations int, residual double")


@query
def grid_search_maxent(spark, folder):
    return linear_search(spark, folder, "maxent")


@query
def grid_search_svm(spark, folder):
    return linear_search(spark, folder, "svm")


def projected(spark, folder, method):
    docs = cleaned(documents(spark, folder)).select("doc_id", "label", "tokens")
    return project(FeatureExtractor().fit_transform(docs), docs, method=method)


@query
def pca_projection(spark, folder):
    return projected(spark, folder, "pca")


@query
def svd_projection(spark, folder):
    return projected(spark, folder, "svd")
