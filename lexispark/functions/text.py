"""Text normalisation and token rules as Catalyst expressions (no Python per row)."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import let

# Character classes. Java's \s is ASCII only, so Unicode blanks are listed explicitly.
BLANK = r"\s\p{Z}\x85\x1C-\x1F"
WORD = r"\p{L}\p{N}_"

URL_PATTERN = rf"https?://[^{BLANK}]+|www\.[^{BLANK}]+"
TAG_PATTERN = r"<[^\n]*?>"
PUNCTUATION_PATTERN = rf"[^{WORD}{BLANK}]+"
DIGIT_PATTERN = r"\p{Nd}+"
# Punctuation and digits are both deleted, so one pass over the union does the same.
NON_LETTER_PATTERN = rf"[^\p{{L}}\p{{Nl}}\p{{No}}_{BLANK}]+"
BLANKS_PATTERN = rf"[{BLANK}]+"

HANGUL_FIRST, HANGUL_LAST = 0xAC00, 0xD7A3


@lru_cache(maxsize=1)
def fold_tables() -> tuple[str, str, str, tuple[str, ...]]:
    """Compatibility decomposition without combining marks, derived from ``unicodedata``.

    Returns the two ``translate`` arguments for one-to-one folds (marks map to nothing), and
    the characters that decompose into several, with their expansions.
    """
    source, target, marks, wide, expansion = [], [], [], [], []
    for code in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF or HANGUL_FIRST <= code <= HANGUL_LAST:
            continue
        char = chr(code)
        if unicodedata.category(char) == "Mn":
            marks.append(char)
            continue
        folded = "".join(c for c in unicodedata.normalize("NFKD", char) if unicodedata.category(c) != "Mn")
        if folded == char:
            continue
        if len(folded) == 1:
            source.append(char)
            target.append(folded)
        elif not folded:
            marks.append(char)
        else:
            wide.append(char)
            expansion.append(folded)
    return "".join(source + marks), "".join(target), "".join(wide), tuple(expansion)


def _class_around(chars: str, gap: int = 32) -> str:
    """A short regular-expression class that covers ``chars`` and may hold a few neighbours.

    It only decides which rows take the slow path, where other characters map to themselves.
    """
    ranges: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if ranges and code <= ranges[-1][1] + gap:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in ranges) + "]"


def _expand_wide(text: Column) -> Column:
    """Replace characters that decompose into several; only rows that hold one get here."""
    _, _, wide, expansion = fold_tables()
    table = F.split(F.lit("\x00".join(expansion)), "\x00")
    return F.array_join(
        F.transform(
            F.split(text, ""),
            lambda ch: F.coalesce(F.get(table, F.instr(F.lit(wide), ch) - 1), ch),
        ),
        "",
    )


def _expand_hangul(text: Column) -> Column:
    """Split composed Hangul syllables into jamo with the standard's arithmetic rule."""

    def jamo(code: Column) -> Column:
        s = code - HANGUL_FIRST
        tail = F.pmod(s, F.lit(28))
        parts = F.concat(
            F.hex(F.floor(s / 588) + 0x1100),
            F.hex(F.floor(F.pmod(s, F.lit(588)) / 28) + 0x1161),
            F.when(tail > 0, F.hex(tail + 0x11A7)).otherwise(F.lit("")),
        )
        return F.decode(F.unhex(parts), "UTF-16BE")

    return F.array_join(
        F.transform(
            F.split(text, ""),
            lambda ch: F.when(ch.between(chr(HANGUL_FIRST), chr(HANGUL_LAST)), jamo(F.ascii(ch))).otherwise(ch),
        ),
        "",
    )


def _is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def fold_unicode(text: Column) -> Column:
    """NFKD with the combining marks dropped. Rows of plain ASCII skip every table.

    Most Latin texts are ASCII after the one-to-one folds; only the others are searched for
    characters that decompose into several.
    """
    source, target, wide, _ = fold_tables()

    def expand(c: Column) -> Column:
        return let(
            F.when(c.rlike(_class_around(wide)), _expand_wide(c)).otherwise(c),
            lambda u: F.when(u.rlike(r"[\x{AC00}-\x{D7A3}]"), _expand_hangul(u)).otherwise(u),
        )

    def fold(c: Column) -> Column:
        return let(F.translate(c, source, target), lambda t: F.when(_is_ascii(t), t).otherwise(expand(t)))

    return let(text, lambda c: F.when(_is_ascii(c), c).otherwise(fold(c)))


def lower_text(text: Column) -> Column:
    """Locale-independent lower case; a missing text is the empty string."""
    return F.lower(F.coalesce(text, F.lit("")))


def remove_urls(text: Column) -> Column:
    return let(
        text,
        lambda c: F.when(
            F.contains(c, F.lit("http")) | F.contains(c, F.lit("www.")), F.regexp_replace(c, URL_PATTERN, "")
        ).otherwise(c),
    )


def remove_tags(text: Column) -> Column:
    return let(
        text, lambda c: F.when(F.contains(c, F.lit("<")), F.regexp_replace(c, TAG_PATTERN, "")).otherwise(c)
    )


def remove_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, PUNCTUATION_PATTERN, "")


def remove_digits(text: Column) -> Column:
    return F.regexp_replace(text, DIGIT_PATTERN, "")


def collapse_blanks(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, BLANKS_PATTERN, " "))


def _letters(folded: Column) -> Column:
    """What is left of a folded text without URLs, tags, punctuation and digits."""
    return F.regexp_replace(remove_tags(remove_urls(folded)), NON_LETTER_PATTERN, "")


def _letters_and_blanks(text: Column) -> Column:
    """Every normalisation step but the last; blanks are still uneven."""
    return _letters(fold_unicode(lower_text(text)))


def normalize(text: Column) -> Column:
    """Lower case, fold, drop URLs, tags, punctuation and digits, even out the blanks."""
    return collapse_blanks(_letters_and_blanks(text))


def tokenize(text: Column) -> Column:
    """Runs of word characters of any text."""
    return F.regexp_extract_all(text, F.lit(f"([{WORD}]+)"), F.lit(1))


def split_blank(text: Column) -> Column:
    """Whitespace split without empty pieces."""
    return F.filter(F.split(text, BLANKS_PATTERN), lambda w: w != "")


def drop_short(tokens: Column, min_length: int = 2) -> Column:
    """Keep tokens of at least ``min_length`` code points."""
    return F.filter(tokens, lambda w: F.length(w) >= min_length)


def drop_stopwords(tokens: Column, stopwords: Sequence[str]) -> Column:
    """Drop stop-words, ignoring case; order and repeats of the others stay."""
    words = sorted(set(stopwords))
    return F.filter(tokens, lambda w: ~F.lower(w).isin(words)) if words else tokens


def _kept(letters: Column, stopwords: Sequence[str], min_length: int) -> Column:
    words = sorted(set(stopwords))

    def keep(w: Column) -> Column:
        long_enough = F.length(w) >= max(min_length, 1)
        return long_enough & ~F.lower(w).isin(words) if words else long_enough

    return F.filter(F.split(letters, BLANKS_PATTERN), keep)


def clean_tokens(text: Column, stopwords: Sequence[str] = (), min_length: int = 2) -> Column:
    """The whole per-document chain from raw text to kept tokens, as one narrow expression."""
    return _kept(_letters_and_blanks(text), stopwords, min_length)


def kept_tokens(folded: Column, stopwords: Sequence[str] = (), min_length: int = 2) -> Column:
    """The rest of the chain for texts that are in lower case and folded."""
    return _kept(_letters(folded), stopwords, min_length)


def process_text(text: Column, stopwords: Sequence[str] = (), min_length: int = 2) -> Column:
    """Raw text to the blank-joined string of kept tokens."""
    return F.array_join(clean_tokens(text, stopwords, min_length), " ")


def feature_tokens(text: Column) -> Column:
    """Tokens a vectorizer sees: lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(lower_text(text), F.lit(f"([{WORD}]{{2,}})"), F.lit(1))
