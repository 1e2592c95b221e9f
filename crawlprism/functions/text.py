"""Text expressions. All of them run in the JVM except ``diacritic_ratio``."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlprism.operators.dictionaries import ENGLISH_COMMON_WORDS, ENGLISH_STOP_WORDS

# Every character for which Python's str.isspace() holds.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202F\u205F\u3000"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
)

# Script ranges, as a Java and RE2 character class.
NON_LATIN = (
    "["
    "\u0400-\u04FF"  # Cyrillic
    "\u0370-\u03FF"  # Greek
    "\u0600-\u06FF"  # Arabic
    "\u0900-\u097F"  # Devanagari
    "\u4E00-\u9FFF"  # CJK ideographs
    "\u3040-\u30FF"  # Hiragana and Katakana
    "\uAC00-\uD7AF"  # Hangul
    "]"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``.

    The optimizer copies a projected expression into every filter that mentions
    it; a lambda variable is bound once per row.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit(WHITESPACE))


def normalize_text(c: Column | str) -> Column:
    """Lower case, whitespace runs to one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(_col(c)), r"\s+", " "))


def digit_density(c: Column | str) -> Column:
    """Share of ASCII digits; an empty text has density 0."""
    c = _col(c)
    # removing the few digits is much cheaper than removing everything else
    digits = F.length(c) - F.length(F.regexp_replace(c, "[0-9]+", ""))
    return digits / F.when(F.length(c) > 0, F.length(c)).otherwise(F.lit(1.0))


def word_tokens(c: Column | str) -> Column:
    """Lower-cased runs of ASCII word characters: what a split on ``\\W`` leaves, several times faster."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit("([A-Za-z0-9_]+)"), 1)


def without_words(tokens: Column | str, words: Iterable[str] = ENGLISH_STOP_WORDS) -> Column:
    words = sorted({w.lower() for w in words})
    if not words:
        return _col(tokens)
    return F.filter(_col(tokens), lambda t: ~F.lower(t).isin(*words))


def term_tokens(c: Column | str) -> Column:
    """Lower-cased runs of two or more Unicode word characters."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(r"([\p{L}\p{N}_]{2,})"), 1)


def ngrams(tokens: Column, n: int) -> Column:
    """Space-joined windows of ``n`` tokens. Pass a plain column: it is read once per position."""
    if n == 1:
        return tokens
    starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(0), F.size(tokens) - n))
    grams = F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(tokens, i + k) for k in range(n)]))
    return F.coalesce(grams, F.array().cast("array<string>"))


def char_chunks(c: Column | str, size: int, step: int | None = None) -> Column:
    """Slices of ``size`` characters taken every ``step`` characters, to the end of the text.

    The text is cut once into ``step``-sized pieces by a linear scan; overlapping
    chunks are joined from neighbouring pieces instead of re-reading the text.
    """
    step = size if step is None else step
    if size <= 0 or step <= 0:
        raise ValueError("size and step must be positive")
    pieces = F.regexp_extract_all(_col(c), F.lit(f"(?s)(.{{1,{step}}})"), 1)
    if step == size:
        return pieces
    if step > size:
        return F.transform(pieces, lambda p: F.substring(p, 1, size))
    span = -(-size // step)
    return let(
        pieces,
        lambda ps: F.transform(
            ps, lambda _, i: F.substring(F.concat_ws("", F.slice(ps, i + 1, F.lit(span))), 1, size)
        ),
    )


def has_non_latin(c: Column | str) -> Column:
    return _col(c).rlike(NON_LATIN)


def ascii_words(c: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(_col(c)), F.lit("([a-zA-Z']+)"), 1)


def common_word_count(words: Column) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(*ENGLISH_COMMON_WORDS)))


def common_word_ratio(c: Column | str) -> Column:
    """Share of ASCII words that are common English words; NULL without words."""
    return let(
        ascii_words(c),
        lambda ws: F.when(F.size(ws) > 0, common_word_count(ws) / F.size(ws)),
    )


def diacritic_ratio(c: Column | str) -> Column:
    """Combining marks after canonical decomposition, over the original length.

    Spark SQL has no decomposition function, so this is an Arrow UDF. ASCII texts
    cannot contain marks and are not sent to Python at all.
    """

    @F.pandas_udf(T.DoubleType())
    def marks_per_char(texts: pd.Series) -> pd.Series:
        import unicodedata

        def ratio(s):
            if not s:
                return 0.0
            marks = sum(unicodedata.category(ch) == "Mn" for ch in unicodedata.normalize("NFD", s))
            return marks / len(s)

        return texts.map(ratio).astype("float64")

    c = _col(c)
    non_ascii = F.when(F.octet_length(c) > F.length(c), c)
    return F.coalesce(marks_per_char(non_ascii), F.lit(0.0))
