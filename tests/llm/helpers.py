"""Small tables with the odd cases that every operator must take."""

from __future__ import annotations

import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _text string, _0 string, key string, node string, a string, ids string, label string, row string"
LONG = "Sentence number one is here, and it goes on. " * 4000
LINE = "This line is long enough to be a key, and many hold it."


def rows(texts: list, first: int = 0) -> list[tuple]:
    """Documents with ids from ``first`` on; columns beyond those of ``documents`` have names that operators use inside."""
    extra = ("x",) * 8
    return [(first + i, t, ("en", "fr")[i % 2], f"src{i % 3}", len(t or ""), *extra) for i, t in enumerate(texts)]


def odd_rows() -> list[tuple]:
    """Null and empty texts, blanks, a very long text, repeated rows, a repeated id with another text, and no id."""
    base = rows([None, "", " \n\t ", LONG, "word", LINE, LINE + "\nAnd one more line of text stands here, of its own.", "ünïcödé — 漢字 ☃"])
    last = base[-1]
    return [*base, base[4], base[4], (5, "another text of the same id", *last[2:]), (None, LINE, *last[2:]), (None, None, *last[2:])]


def frame(spark, data: list[tuple]):
    return spark.createDataFrame(data, SCHEMA)


def fold(text: str | None) -> str:
    """A-Z in lower case."""
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text: str | None) -> list[str]:
    return re.findall("[^ \t\n\x0b\f\r]+", fold(text))
