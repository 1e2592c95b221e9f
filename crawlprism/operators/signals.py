"""Keyword filters, regex signals and the cites / repackages label."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlprism.functions import text as X
from crawlprism.functions.urls import DEFAULT_TLDS, in_domains
from crawlprism.operators import dictionaries as D

_META = re.compile(r"[\\^$.|?*+()\[\]{}]")


def _any(conditions: Iterable[Column]) -> Column:
    result = None
    for condition in conditions:
        result = condition if result is None else result | condition
    return F.lit(False) if result is None else result


# --- keywords -----------------------------------------------------------------------


def keyword_pattern(keywords: Iterable[str], escape: bool = False) -> str:
    """Alternation of the keywords. Unescaped by default: ``.`` and ``()`` keep their regex meaning."""
    return "|".join(re.escape(k) if escape else k for k in keywords)


def mentions(text: Column, keywords: Iterable[str], escape: bool = False) -> Column:
    """Does ``text`` match any keyword? Same answer as one regex alternation.

    Keywords without regex characters are plain byte searches; only the others go
    through the regex engine, and only when no plain keyword was found.
    """
    keywords = list(keywords)
    plain = [k for k in keywords if escape or not _META.search(k)]
    special = [k for k in keywords if k not in plain]
    if any(_compiles(k) is None for k in special):
        return text.rlike(keyword_pattern(keywords, escape))
    tests = [text.contains(k) for k in plain]
    if special:
        tests.append(text.rlike(keyword_pattern(special)))
    return _any(tests)


def _compiles(pattern: str):
    try:
        return re.compile(pattern)
    except re.error:
        return None


def filter_by_keywords(
    df: DataFrame, keywords: Iterable[str], text_col: str = "content", escape: bool = False
) -> DataFrame:
    """Rows whose lower-cased text mentions any keyword."""
    return df.where(X.let(F.lower(F.col(text_col)), lambda t: mentions(t, keywords, escape)))


def filter_by_domain(
    df: DataFrame, url_col: str = "target_uri", tlds: Iterable[str] = DEFAULT_TLDS
) -> DataFrame:
    return df.where(in_domains(url_col, tlds))


def _keywords(lists: dict[str, list[str]]) -> list[tuple[str, str]]:
    return [(name, word) for name, words in lists.items() for word in words]


def keyword_hits(
    df: DataFrame,
    id_cols: list[str],
    text_col: str = "content",
    lists: dict[str, list[str]] = D.KEYWORD_LISTS,
    escape: bool = False,
    misses: bool = False,
) -> DataFrame:
    """Long form: one row per (page, list, keyword) that the page mentions; with ``misses`` one row for every keyword.

    Only hits leave the row; no join is involved.
    """

    def entries(t: Column) -> Column:
        return F.array(
            *[
                F.struct(F.lit(name).alias("list_name"), F.lit(word).alias("keyword"), mentions(t, [word], escape).alias("hit"))
                for name, word in _keywords(lists)
            ]
        )

    every = X.let(F.lower(F.col(text_col)), entries)
    return df.select(*id_cols, F.inline(every if misses else F.filter(every, lambda e: e["hit"])))


def keyword_counts(
    df: DataFrame, text_col: str = "content", lists: dict[str, list[str]] = D.KEYWORD_LISTS, escape: bool = False
) -> DataFrame:
    """Pages per (list, keyword), zeros included. One row of counters is aggregated and then turned."""
    pairs = _keywords(lists)
    lowered = df.select(F.inline(F.array(F.struct(F.lower(F.col(text_col)).alias("_lowered")))))
    one = lowered.agg(*[F.count_if(mentions(F.col("_lowered"), [w], escape)).alias(f"k{i}") for i, (_, w) in enumerate(pairs)])
    rows = [
        F.struct(F.lit(n).alias("list_name"), F.lit(w).alias("keyword"), F.col(f"k{i}").alias("pages"))
        for i, (n, w) in enumerate(pairs)
    ]
    return one.select(F.inline(F.array(*rows)))


# --- regex signals --------------------------------------------------------------------


def _guarded(text: Column, pattern: str, hints: Iterable[str], searched: Column) -> Column:
    hints = tuple(hints)
    test = text.rlike(pattern)
    return _any(searched.contains(h) for h in hints) & test if hints else test


def signal_columns(
    text_col: str = "text_norm", signals: dict[str, str] = D.CENSUS_SIGNALS
) -> dict[str, Column]:
    """One boolean per pattern over *normalised* text."""
    c = F.col(text_col)
    return {
        name: _guarded(c, pattern, D.CENSUS_HINTS.get(name, ()) if signals is D.CENSUS_SIGNALS else (), c)
        for name, pattern in signals.items()
    }


def with_signals(df: DataFrame, text_col: str = "text_norm") -> DataFrame:
    return df.withColumns(signal_columns(text_col))


def with_acs_signals(df: DataFrame, text_col: str = "content") -> DataFrame:
    """Survey patterns over the raw text (they carry their own case flags)."""
    lowered = df.withColumn("_lower", F.lower(F.col(text_col)))
    flags = {
        name: _guarded(F.col(text_col), pattern, D.ACS_HINTS.get(name, ()), F.col("_lower"))
        for name, pattern in D.ACS_SIGNALS.items()
    }
    return lowered.withColumns(flags).drop("_lower")


def any_signal(names: Iterable[str]) -> Column:
    """At least one flag is true; NULL flags are ignored unless all are NULL."""
    return F.array_max(F.array(*[F.col(n).cast("int") for n in names])) == 1


def has_attribution() -> Column:
    return _any(F.col(n) for n in D.ATTRIBUTION_SIGNALS)


def has_publisher_domain() -> Column:
    return _any(F.col(n) for n in D.DOMAIN_SIGNALS)


def long_enough(
    df: DataFrame, text_col: str = "content", out_col: str = "text_norm", min_length: int = D.MIN_TEXT_LENGTH
) -> DataFrame:
    """Add the normalised text and keep rows where it is longer than ``min_length``.

    The filter sits inside the generator, so the text is normalised once; a plain
    ``where`` would be pushed below the projection and normalise it twice.
    """
    normalised = F.filter(F.array(X.normalize_text(text_col)), lambda t: F.length(t) > min_length)
    return df.select("*", F.explode(normalised).alias(out_col))


def enrich(df: DataFrame, text_col: str = "content") -> DataFrame:
    """Normalised text, 29 signals, digit density, derived flags and the label (NULL when neither)."""
    flagged = with_signals(long_enough(df, text_col)).withColumn(
        "num_density", X.digit_density("text_norm")
    )
    return (
        flagged.withColumns(
            {
                "has_any_census": any_signal(D.CENSUS_SIGNALS),
                "has_explicit_attrib": has_attribution(),
                "has_census_domain": has_publisher_domain(),
            }
        )
        .withColumn(
            "repackage_heuristic",
            (F.col("num_density") > D.REPACKAGE_DENSITY)
            & ~F.col("has_explicit_attrib")
            & ~F.col("has_census_domain"),
        )
        .withColumn(
            "label",
            F.when(F.col("has_explicit_attrib") | F.col("has_census_domain"), "cites").when(
                F.col("repackage_heuristic"), "repackages"
            ),
        )
    )


def label_pages(df: DataFrame, text_col: str = "content") -> DataFrame:
    """Labelled pages only."""
    return enrich(df, text_col).where(F.col("label").isNotNull())


# --- survey table identifiers -----------------------------------------------------------


def table_ids(text: Column, corrected: bool = False) -> Column:
    """Distinct listed table identifiers that stand alone in the text (upper-cased)."""
    ids = set(D.ACS_TABLE_IDS) | (set(D.CORRECTED_TABLE_IDS.values()) if corrected else set())
    words = F.regexp_extract_all(F.upper(text), F.lit("([0-9A-Z_]+)"), 1)
    return F.array_distinct(F.filter(words, lambda w: w.isin(*sorted(ids))))


def product_names(text: Column, corrected: bool = False) -> Column:
    """Listed product names that occur literally in the text."""
    names = list(D.ACS_PRODUCT_NAMES) + (list(D.CORRECTED_ACS_NAMES.values()) if corrected else [])
    return F.filter(F.array(*[F.lit(n) for n in names]), lambda n: F.contains(text, n))
