import random

from pyspark.sql import functions as F

from lexispark.functions import text as tx
from lexispark.functions.stopwords import load_stopwords
from lexispark.operators.cleanup import processed
from lexispark.operators.features import FeatureExtractor
from lexispark.operators.naive_bayes import class_sums

POOL = "abzİIıŞşğç éßæ 12_-.<>/:\n\t \u0085\x1c\x1f\x0b\x07\x7f ﬁ…½²①㎏가각ﷺ＜＞http://www.ΑΣςж“”—ˇℌ𝒜 "


def texts():
    rng = random.Random(11)
    rows = ["".join(rng.choice(POOL) for _ in range(rng.randint(0, 50))) for _ in range(800)]
    rows += ["the a ab _x", "see http://a.b/c>z <b>The</b> end", "www.x\x1cy z<a\nb>c", "straße — “The” Æther", "  ", "", None]
    return rows + ["q" + chr(c) + " the" + chr(c) + " z" + chr(c) + "z" for c in range(1, 0x3000)]


def test_batches_equal_the_expressions(spark):
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts())], "doc_id int, text string, label string").repartition(4)
    for stop, least in ((load_stopwords("english"), 2), ((), 0), (("ab", "É", "The", "straße"), 3)):
        out = processed(docs, stop, least)
        assert out.columns == ["doc_id", "label", "tokens"]
        both = docs.select("doc_id", tx.process_text(F.col("text"), stop, least).alias("want")).join(out, "doc_id")
        assert both.count() == docs.count()
        assert both.where("NOT want <=> tokens").collect() == []


def test_weights_need_no_shuffle_unless_keys_repeat(spark):
    """One row a document: its norm is its own (before: every array of a document went through a window)."""
    docs = spark.createDataFrame([(1, "ab cd ab"), (2, "cd ef"), (3, "ab ef ef"), (4, None), (5, "zz")], "doc_id int, tokens string")
    extractor = FeatureExtractor(min_df=1).fit(docs)
    single = extractor.transform(docs)
    assert "Window" not in single._jdf.queryExecution().executedPlan().toString()
    repeated = extractor.transform(docs.unionByName(spark.createDataFrame([(9, "ab"), (9, "cd")], "doc_id int, tokens string")))
    rows = {(r.doc_id, r.term): (r.tf, r.weight) for r in single.collect()}
    again = {(r.doc_id, r.term): (r.tf, r.weight) for r in repeated.where("doc_id < 9").collect()}
    assert rows == again and rows[1, "ab"][0] == 2
    assert abs(sum(w * w for (d, _), (_, w) in rows.items() if d == 1) - 1) < 1e-12
    nine = [r.weight for r in repeated.where("doc_id = 9").collect()]
    assert len(nine) == 2 and abs(sum(w * w for w in nine) - 1) < 1e-12


def test_class_sums_are_added_by_hash(spark):
    rows = [(1, "a", "x", 1.0), (1, "a", "y", 2.0), (1, None, "x", 4.0), (2, "b", "y", 0.5), (2, "b", None, 9.0), (3, "c", None, 1.0)]
    sums = class_sums(spark.createDataFrame(rows, "idx int, term string, label string, weight double"), ["x", "y"])
    assert {r.idx: list(r.n) for r in sums.collect()} == {1: [5.0, 2.0], 2: [0.0, 0.5], 3: [0.0, 0.0]}
    # only the second, small step may sort
    first = sums._jdf.queryExecution().sparkPlan().toString().strip().splitlines()
    assert [line for line in first if "Aggregate" in line][-1].strip(" :+-").startswith("HashAggregate")
