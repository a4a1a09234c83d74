import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from lexispark.functions import arrays, stopwords, text


def expected(value):
    """The rules in plain Python, in their order."""
    if value is None:
        return ""
    value = unicodedata.normalize("NFKD", value.lower())
    for pattern in (r"https?://\S+|www\.\S+", r"<.*?>", r"[^\w\s]", r"\d+"):
        value = re.sub(pattern, "", value)
    return re.sub(r"\s+", " ", value).strip()


RULE_ROWS = [
    (None, ""),
    ("Bu çok GÜZEL bir İstanbul ışığı için", "bu cok guzel bir istanbul ısıgı icin"),
    ("café ½ x² ﬁn <b>hi</b> see http://a.b/c>z foo_bar", "cafe x fin hi see foo_bar"),
    ('<a href="http://x.y">link</a> tail', "a href tail"),
    ("a b", "a b"),
    ("x_1 y\n z\t", "x_ y z"),
    ("", ""),
    ("   ", ""),
    ("www.x.y/z next", "next"),
    ("a<b\nc>d", "ab cd"),
]


def run(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.o for r in df.select("i", fn(F.col("t")).alias("o")).orderBy("i").collect()]


def test_rules(spark):
    assert run(spark, [t for t, _ in RULE_ROWS], text.normalize) == [e for _, e in RULE_ROWS]


def test_every_code_point_matches_python(spark):
    """Each character between letters; composed Hangul is compared after decomposition too."""
    old = unicodedata.ucd_3_2_0  # letters added later are unknown to the JVM's older tables
    known = [chr(c) for c in range(1, 0x30000) if old.category(chr(c)) not in ("Cn", "Co", "Cs")]
    values = ["q" + c + " z" + c + c for c in known]
    got = run(spark, values, text.normalize)
    wrong = [(hex(ord(c)), expected(v), g) for c, v, g in zip(known, values, got) if expected(v) != g]
    assert not wrong, (len(wrong), wrong[:20])


def test_random_strings(spark):
    rng = random.Random(7)
    pool = "abzİIıŞşğç éß 12_-.<>/:\n\t \u0085 ﬁ…½²①㎏가각ﷺ＜＞http://www.ΑΣς "
    values = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(500)]
    values += [v + "http://" + v + " www." + v for v in values[:100]]
    assert run(spark, values, text.normalize) == [expected(v) for v in values]


def test_steps_compose_to_normalize(spark):
    values = [t for t, _ in RULE_ROWS]

    def steps(c):
        c = text.remove_tags(text.remove_urls(text.fold_unicode(text.lower_text(c))))
        return text.collapse_blanks(text.remove_digits(text.remove_punctuation(c)))

    assert run(spark, values, steps) == run(spark, values, text.normalize)


def test_token_rules(spark):
    values = ["Bir elma ve bir armut a", "x", ""]
    tokens = lambda c: text.tokenize(c)
    assert run(spark, values, tokens)[0] == ["Bir", "elma", "ve", "bir", "armut", "a"]
    assert run(spark, values, lambda c: text.drop_short(tokens(c)))[0] == ["Bir", "elma", "ve", "bir", "armut"]
    assert run(spark, values, lambda c: text.drop_stopwords(tokens(c), ["bir", "ve"]))[0] == ["elma", "armut", "a"]
    assert run(spark, values, lambda c: text.process_text(c, ["ve"])) == ["bir elma bir armut", "", ""]


def test_chain_equals_separate_steps(spark, sf_dir):
    stop = stopwords.load_stopwords("english")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    separate = text.drop_stopwords(text.drop_short(text.tokenize(text.normalize(F.col("text")))), stop)
    assert docs.where(text.clean_tokens(F.col("text"), stop) != separate).count() == 0


def test_stopword_lists(spark):
    assert stopwords.list_name("Türkçe") == "turkish" and stopwords.list_name("German") == "german"
    assert len(stopwords.BASIC_TURKISH) == 64 == len(set(stopwords.BASIC_TURKISH))
    assert stopwords.load_stopwords("klingon") == sorted(stopwords.BASIC_TURKISH)
    assert stopwords.load_stopwords("tr", remove_stopwords=False) == []
    assert "xyz" in stopwords.load_stopwords("en", custom=["xyz"])
    # accented entries do not match folded tokens unless asked to
    plain, folded = (stopwords.load_stopwords("klingon", fold=f) for f in (False, True))
    assert run(spark, ["çok iyi"], lambda c: text.process_text(c, plain)) == ["cok iyi"]
    assert run(spark, ["çok iyi"], lambda c: text.process_text(c, folded)) == ["iyi"]


@pytest.mark.parametrize("lo,hi", [(1, 1), (1, 2), (2, 2), (1, 3), (2, 4)])
def test_ngrams(spark, lo, hi):
    values = ["a b c d", "a", "", "a b"]
    got = run(spark, values, lambda c: arrays.ngrams(text.split_blank(c), lo, hi))
    for value, grams in zip(values, got):
        words = value.split()
        want = [" ".join(words[i : i + n]) for n in range(lo, hi + 1) for i in range(len(words) - n + 1)]
        assert sorted(grams) == sorted(want)
    with pytest.raises(ValueError):
        arrays.ngrams(F.col("t"), 2, 1)


def test_term_counts(spark):
    got = run(spark, ["b a b", "", "a"], lambda c: arrays.term_counts(text.split_blank(c)))
    assert [[tuple(x) for x in row] for row in got] == [[("a", 1), ("b", 2)], [], [("a", 1)]]


def test_argmax_softmax(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],), ([-1000.0, -1000.0, -2000.0],)], "v array<double>")
    rows = df.select(arrays.argmax(F.col("v")).alias("a"), arrays.softmax(F.col("v")).alias("p")).collect()
    assert [r.a for r in rows] == [1, 0]
    assert rows[1].p == [0.5, 0.5, 0.0] and abs(sum(rows[0].p) - 1) < 1e-12
