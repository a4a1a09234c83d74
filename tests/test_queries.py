"""Registered queries against their SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from verification.queries import QUERIES

TABLES = "documents labels pages conversations benchmark embeddings".split()
# one or two of each family; the whole set is compared outside the unit tests
CHECKED = [
    "dataset_label_crosstab", "csv_corpus_roundtrip", "normalize_pages", "custom_stopword_antijoin", "lemma_lookup", "processed_text",
    "full_vocabulary", "tfidf_weights", "unbounded_tfidf", "nb_complement_predict", "resumed_run", "nb_grid_search", "nb_holdout_report", "random_split", "stopword_filter_by_code",
    "comparison_without_probability", "timings_unpivot", "nb_learning_curve",
    "stratified_folds", "stratified_sample", "class_report", "roc_points", "ovr_auc_per_class", "model_comparison",
    "doc_length_histogram", "doc_length_density", "word_frequency_by_class", "feature_correlation", "ml_vectors", "ml_vector_entries", "exact_tree_nodes", "exact_tree_predict", "exact_tree_importances",
]


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def printed(value):
    if value is None:
        return "null"
    return "nan" if isinstance(value, float) and math.isnan(value) else repr(value)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = contract.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(tuple(printed(r[c]) for c in columns) for r in df.collect())
    sql = duck.sql(contract.oracle_sql()[name])
    assert sorted(sql.columns) == columns
    places = [sql.columns.index(c) for c in columns]
    assert got == sorted(tuple(printed(row[i]) for i in places) for row in sql.fetchall())


def test_contract():
    names = set(contract.queries())
    assert set(contract.oracle_sql()) <= names
    fitted = {n for n in QUERIES if n not in contract.oracle_sql()}
    assert fitted == {
        "decision_tree", "tree_nodes", "maxent", "maxent_coefficients", "linear_svm_calibrated", "random_forest",
        "forest_importances", "grid_search_ml", "grid_search_maxent", "grid_search_svm", "pca_projection", "svd_projection",
    }


def test_ngrams_are_added_up_before_the_shuffle(spark, sf_dir):
    """Tasks count the n-grams of their rows in batches (before: one row for every occurrence)."""
    plan = QUERIES["ngrams_up_to_three"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan
