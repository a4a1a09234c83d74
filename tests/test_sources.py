import pytest
from pyspark.sql import functions as F

from lexispark.sources import artifacts, corpus
from tests.fixtures import sentiment

HEADER = "text,label,dataset\n"


@pytest.fixture
def csv(tmp_path):
    train, test = tmp_path / "train.csv", tmp_path / "test.csv"
    train.write_text(HEADER + '"iyi, güzel ""film""",1,a\n"iki\nsatır",0,b\n,1,a\n', encoding="utf-8")
    test.write_text(HEADER + "kötü,0,b\n", encoding="utf-8")
    return str(train), str(test)


def test_load_csv(spark, csv):
    train, test = corpus.load_data(spark, *csv)
    assert {r.text for r in train.collect()} == {'iyi, güzel "film"', "iki\nsatır", None}
    assert train.select("doc_id").distinct().count() == 3
    typed = corpus.corpus_schema(label_type="int", extra={"dataset": "string"})
    train, _ = corpus.load_data(spark, *csv, schema=typed)
    assert train.schema["label"].dataType.typeName() == "integer"
    docs = corpus.union_splits(train, test.withColumn("label", F.col("label").cast("int")))
    assert {(r.split, r.n_missing) for r in corpus.missing_texts(docs).collect()} == {("train", 1), ("test", 0)}
    sizes = {r.split: r.n_rows for r in corpus.split_sizes(docs).collect()}
    assert sizes == {"train": 3, "test": 1}


def test_load_errors(spark, csv, tmp_path):
    with pytest.raises(FileNotFoundError, match="test data"):
        corpus.load_data(spark, csv[0], str(tmp_path / "none.csv"))
    with pytest.raises(ValueError, match="'etiket'.*train"):
        corpus.load_data(spark, *csv, label_column="etiket")
    with pytest.raises(FileNotFoundError):
        artifacts.load_results(spark, str(tmp_path), ["none"])


def test_counts_skip_missing_values(spark):
    docs = sentiment(spark)
    counts = corpus.dataset_counts(docs)
    assert sum(r.n for r in counts.collect()) == 25
    assert corpus.dataset_counts(docs.drop("dataset")) is None
    table = {r.dataset: (r["0"], r["1"]) for r in corpus.crosstab(docs, "dataset", "label", [0, 1]).collect()}
    assert table == {"a": (4, 5), "b": (8, 8)}


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_processed_round_trip(spark, tmp_path, fmt):
    docs = sentiment(spark).withColumn("processed_text", F.coalesce("text", F.lit("")))
    parts = [docs.where(F.col("split") == s) for s in ("train", "test")]
    corpus.save_processed(*parts, str(tmp_path), fmt)
    schema = docs.drop("split").schema
    back = corpus.union_splits(*corpus.load_processed(spark, str(tmp_path), schema, fmt))
    key = lambda r: r.doc_id
    assert sorted(back.select(docs.columns).collect(), key=key) == sorted(docs.collect(), key=key)


def test_random_split(spark):
    split = corpus.random_split(spark.range(5000).withColumnRenamed("id", "doc_id"))
    share = split.where(F.col("split") == "test").count() / 5000
    assert 0.17 < share < 0.23


def test_blanks_and_line_ends_of_texts_survive_csv(spark, tmp_path):
    texts = ["  both ends  ", "\ttab", "line\nend\n", 'a "quoted" word', "", None, ",", "crlf\r\nhere"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, label string")
    corpus.save_processed(docs, docs.limit(0), str(tmp_path))
    train, test = corpus.load_processed(spark, str(tmp_path), docs.schema)
    assert [r.text for r in train.orderBy("doc_id").collect()] == texts and test.count() == 0
