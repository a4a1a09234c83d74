from collections import Counter

from lexispark.llm.common import table
from lexispark.llm.quality import clean_lines

from .helpers import frame, odd_rows, rows

PROSE = "The first sentence of this text is plain, and it ends as it should. Another one follows it here. "


def base(text):
    words = [w for w in __import__("re").findall("[^ \t\n\x0b\f\r]+", text or "")]
    tri = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {t for t, n in Counter(tri).items() if n > 1}
    hit = {i + k for i, t in enumerate(tri) if t in twice for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\x0b\f\r")]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)


def test_base_counts(spark):
    data = odd_rows() + rows(["a b c\na b c\na b c\n\n \n", "x # y|z <b> && 5%", "one one one one", "t\n" * 5, "é è\nÉ è"], 100)
    got = clean_lines(frame(spark, data)).collect()
    want = sorted((str(r[0]), *base(r[1])) for r in data)
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


def distinct_prose(n):
    return "\n".join(f"Sentence{i} of{i} text says{i} {i * 7} things, and{i} number {i * 13} ends{i} it well{i}." for i in range(n))


def test_failed_lines_go(spark):
    text = distinct_prose(8) + "\nHome | News | Sport | More\nAccept cookies to go on\nMenu\nBUY NOW THIS GREAT OFFER TODAY FRIENDS\nwow!! so!! much!! here!!\n" + "a### b### c### d###"
    (r,) = clean_lines(frame(spark, rows([text]))).collect()
    assert r.cleaned == distinct_prose(8) and r.kept
    assert r.failed == {"navigation": 1, "boilerplate": 1, "stub": 1, "capitals": 1, "marks": 1, "symbols": 1}


def test_texts_that_lose_too_much_are_rejected(spark):
    junk = "\n".join(f"Item{i}a | Item{i}b | Item{i}c | more{i} words{i}" for i in range(30))
    got = clean_lines(frame(spark, rows([distinct_prose(10), junk, distinct_prose(2) + "\n" + junk]))).orderBy("doc_id").collect()
    assert [r.kept for r in got] == [True, False, False] and not any(r.base_failed for r in got)


def test_verdict_against_labels(spark, sf_dir):
    judged = clean_lines(table(spark, sf_dir, "documents")).join(table(spark, sf_dir, "labels"), "doc_id").where("not base_failed").collect()
    good = [r.kept for r in judged if r.quality == 1]
    bad = [r.kept for r in judged if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.3 * len(bad)


def test_empty_table(spark):
    assert clean_lines(frame(spark, [])).count() == 0
