"""Stop-word lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.feature import StopWordsRemover

# Language names that select a list under another name.
LANGUAGE_ALIASES = {
    "türkçe": "turkish",
    "tr": "turkish",
    "turkish": "turkish",
    "ingilizce": "english",
    "en": "english",
    "english": "english",
}

# Turkish list used where no list exists for the asked language.
BASIC_TURKISH = (
    "acaba ama aslında az bazı belki biri birkaç birşey biz bu çok çünkü da daha de defa diye eğer en gibi hem hep "
    "hepsi her hiç için ile ise kez ki kim mı mu mü nasıl ne neden nerde nerede nereye niçin niye o sanki şey siz şu "
    "tüm ve veya ya yani bir 1 2 3 4 5 6 7 8 9 0"
).split()


def list_name(language: str) -> str:
    """Name of the stop list for ``language``; unknown names pass through in lower case."""
    return LANGUAGE_ALIASES.get(language.lower(), language.lower())


def load_stopwords(
    language: str = "turkish",
    custom: Iterable[str] | None = None,
    remove_stopwords: bool = True,
    fold: bool = False,
) -> list[str]:
    """Sorted stop-words for ``language`` plus ``custom`` ones.

    The list is matched against folded tokens, so entries with diacritics never match unless
    ``fold`` adds their folded spelling.
    """
    if not remove_stopwords:
        return []
    name = list_name(language)
    try:
        words = set(StopWordsRemover.loadDefaultStopWords(name))
    except Exception:  # no list ships under that name
        words = set(BASIC_TURKISH)
    words.update(custom or ())
    if fold:
        words.update(_fold_word(w) for w in tuple(words))
    return sorted(words)


def _fold_word(word: str) -> str:
    import unicodedata

    folded = unicodedata.normalize("NFKD", word.lower())
    return "".join(c for c in folded if unicodedata.category(c) != "Mn")
