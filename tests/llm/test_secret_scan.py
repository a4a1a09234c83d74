import random

from pyspark.sql import functions as F

from lexispark.llm import secret_scan as ss

from .helpers import frame, odd_rows, rows


def secret():
    return "".join(random.choice("0123456789abcdef") for _ in range(40))


def texts(n, seed=1):
    random.seed(seed)
    out = []
    for i in range(n):
        prose = "plain words of a sentence that go on for some time and end here"
        if i % 3 == 0:
            out.append(f'{prose} token = "{secret()}" {prose}')
        elif i % 3 == 1:
            out.append(f"{prose} internationalisation antidisestablishmentarian number {random.randint(10**15, 10**16 - 1)} {prose}")
        else:
            out.append(f"{prose} see http://example.com/some/long/path/of/words for more {prose}")
    return out


def test_findings_equal_brute_force(spark):
    import re

    data = odd_rows() + rows(texts(12) + ["a" * 16, "x" * 15, "ab/" * 6 + "!" + "Z9" * 8, "\n" + "k" * 20 + "\n"], 100)
    got = ss.findings(frame(spark, data)).select("_id", "position", "part", "value", "before", "after").collect()
    want = []
    for r in data:
        words = re.split("[ \t\n\x0b\f\r]+", r[1] or "")
        for i, w in enumerate(words):
            for k, v in enumerate(re.findall("[A-Za-z0-9+/_-]{16,}", w)):
                want.append((r[0], i, k, v, words[i - 1].lower() if i else None, words[i + 1].lower() if i + 1 < len(words) else None))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_transitions_are_log_probabilities(spark):
    words = spark.createDataFrame([("abab", 3), ("ac", 1)], "word string, n bigint")
    got = {r.pair: r.logp for r in ss.transitions(words).collect()}
    import math

    assert abs(got["ab"] - math.log((6 + 1) / (7 + 37))) < 1e-9 and abs(got["ba"] - math.log(4 / (3 + 37))) < 1e-9


def test_held_out_findings(spark):
    data = rows(texts(240) * 1, 0)
    got = ss.scan(frame(spark, data)).withColumn("held", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1).where("held").collect()
    assert len(got) > 40
    for r in got:
        assert r.kept == (len(r.value) == 40 and r.doc_id % 3 == 0), r
        assert 0 <= r.score <= 1


def test_given_labels_decide(spark):
    docs = frame(spark, rows(texts(60)))
    found = ss.findings(docs)
    labelled = found.withColumn("label", F.when(F.col("value").rlike("^[0-9]{16}$"), 1).otherwise(0))
    got = ss.scan(docs, labelled).collect()
    assert all(r.kept == (r.value.isdigit() and len(r.value) == 16) for r in got)


def test_nothing_to_learn_keeps_all(spark):
    got = ss.scan(frame(spark, rows(["internationalisation of words here"]))).collect()
    assert [(r.kept, r.score) for r in got] == [(True, None)]
    assert ss.scan(frame(spark, [])).count() == 0


def test_no_python_on_the_executors(spark):
    plan = ss.scan(frame(spark, rows(texts(30))))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "MapInArrow" not in plan
