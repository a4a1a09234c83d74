from pyspark.sql import functions as F

from lexispark.operators import selection as sel

SEEN = []


class Majority:
    """Remembers the keys it was fitted on and answers with one label."""

    def fit(self, rows):
        SEEN.append(sorted(r.doc_id for r in rows.collect()))
        return self

    def predict(self, rows):
        return rows.select("label", F.lit(1).alias("prediction"))


def test_training_sets_are_nested_prefixes_by_key(spark):
    SEEN.clear()
    df = spark.createDataFrame([(i * 7 % 61, i % 2, i % 3) for i in range(60)], "doc_id bigint, label int, fold int")
    curve = sel.learning_curve(Majority, df, (0.25, 0.5, 1.0), 3, parallelism=1)
    rows = [(r.doc_id, r.fold) for r in df.collect()]
    want = [sorted(i for i, g in rows if g != f)[:size] for size in (10, 20, 40) for f in range(3)]
    assert sorted(SEEN) == sorted(want) and curve.count() == 9
