"""Dictionaries, keyword matching and the byte-search hints in front of the regexes."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from crawlprism.functions import text as X
from crawlprism.operators import dictionaries as D
from crawlprism.operators import signals
from crawlprism.registry.fixtures import phrased, salted


def test_sizes():
    assert len(D.PRODUCT_KEYWORDS) == 8 and len(D.GEOGRAPHIC_KEYWORDS) == 11
    assert len(D.SUBJECT_KEYWORDS) == 50 == len(set(D.SUBJECT_KEYWORDS))
    assert len(D.CENSUS_SIGNALS) == 29 and len(D.ACS_SIGNALS) == 11
    assert len(D.ACS_TABLE_IDS) == 86 == len(set(D.ACS_TABLE_IDS))
    assert len(D.ACS_PRODUCT_NAMES) == 11
    assert set(D.CENSUS_HINTS) == set(D.CENSUS_SIGNALS)
    assert set(D.ACS_HINTS) <= set(D.ACS_SIGNALS)


def test_stop_words_are_sparks_default(spark):
    assert sorted(D.ENGLISH_STOP_WORDS) == sorted(StopWordsRemover.loadDefaultStopWords("english"))


@pytest.mark.parametrize("name", list(D.CENSUS_SIGNALS))
def test_census_hints_are_implied(name):
    pattern = re.compile(D.CENSUS_SIGNALS[name], re.ASCII)

    @settings(max_examples=60, suppress_health_check=list(HealthCheck), deadline=None)
    @given(st.from_regex(pattern))
    def check(raw):
        text = re.sub(r"[ \t\n\x0b\f\r]+", " ", raw.lower()).strip(" ")
        if pattern.search(text):
            assert any(h in text for h in D.CENSUS_HINTS[name]), text

    check()


@pytest.mark.parametrize("name", list(D.ACS_HINTS))
def test_acs_hints_are_implied(name):
    pattern = re.compile(D.ACS_SIGNALS[name], re.ASCII)

    @settings(max_examples=60, suppress_health_check=list(HealthCheck), deadline=None)
    @given(st.from_regex(pattern))
    def check(raw):
        assert any(h in raw.lower() for h in D.ACS_HINTS[name]), raw

    check()


def test_hints_do_not_change_flags(spark, sf):
    df = signals.long_enough(phrased(spark, sf).unionByName(salted(spark, sf).select("doc_id", "content")))
    plain = [
        (name, F.col("text_norm").rlike(pattern)) for name, pattern in D.CENSUS_SIGNALS.items()
    ]
    hinted = signals.signal_columns()
    differs = df.agg(*[F.count_if(c != hinted[n]).alias(n) for n, c in plain]).first().asDict()
    assert not any(differs.values()), differs
    raw = signals.with_acs_signals(df.select("content"))
    differs = raw.agg(
        *[F.count_if(F.col(n) != F.col("content").rlike(p)).alias(n) for n, p in D.ACS_SIGNALS.items()]
    ).first().asDict()
    assert not any(differs.values()), differs


def test_every_signal_fires(spark, sf):
    flagged = signals.with_acs_signals(signals.enrich(phrased(spark, sf)))
    hits = flagged.agg(*[F.count_if(n).alias(n) for n in [*D.CENSUS_SIGNALS, *D.ACS_SIGNALS]]).first().asDict()
    assert min(hits.values()) > 0, hits


def test_agriculture_is_not_generic(spark):
    df = spark.createDataFrame([("the census of agriculture " + "x" * 100,)], "content string")
    assert signals.enrich(df).first()["census_generic"] is False


KEYWORD_TEXTS = [
    "u.s. census bureau", "uxsx census bureau", "tenure (owner/renter)", "tenure owner/renter",
    "computer & internet use", "age; sex", "rent", "current", "RENT", "", None,
]


@pytest.mark.parametrize("escape", [False, True])
@pytest.mark.parametrize("words", [*D.KEYWORD_LISTS.values(), ["a(b", "c)d"], ["[", "x"]])
def test_mentions_equals_the_alternation(spark, words, escape):
    df = spark.createDataFrame([(t,) for t in KEYWORD_TEXTS], "t string")
    pattern = signals.keyword_pattern(words, escape)
    try:
        re.compile(pattern)
    except re.error:
        pytest.skip("the alternation itself is no regex")
    low = F.lower("t")
    rows = df.select("t", low.rlike(pattern).alias("a"), signals.mentions(low, words, escape).alias("b")).collect()
    assert [r["a"] for r in rows] == [r["b"] for r in rows]


def test_unescaped_dot_is_a_wildcard(spark):
    df = spark.createDataFrame([("uxsx census",), ("u.s. census",)], "content string")
    assert signals.filter_by_keywords(df, ["u.s. census"]).count() == 2
    assert signals.filter_by_keywords(df, ["u.s. census"], escape=True).count() == 1


def test_labels(spark):
    pad = " lorem" * 30
    texts = {
        "Source: U.S. Census Bureau" + pad: "cites",
        "see API.census.gov" + pad: "cites",
        "1234567890 " * 20: "repackages",
        "source: the us census bureau " + "1234567890 " * 20: "cites",
        "plain" + pad: None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "content string")
    got = {r["content"]: r["label"] for r in signals.enrich(df).collect()}
    assert got == texts
    assert signals.label_pages(df).count() == 4


def test_density_of_empty_text(spark):
    df = spark.createDataFrame([("",), ("a1",), ("123",)], "t string")
    assert [r[0] for r in df.select(X.digit_density("t")).collect()] == [0.0, 0.5, 1.0]


def test_any_signal_ignores_null(spark):
    df = spark.createDataFrame([(None, True), (None, False), (None, None)], "a boolean, b boolean")
    assert [r[0] for r in df.select(signals.any_signal(["a", "b"])).collect()] == [True, False, None]


def test_corrected_entries_are_off_by_default(spark):
    df = spark.createDataFrame([("OnTheMap for Emergency Management in S2301 and 2301",)], "t string")
    row = df.select(
        signals.product_names(F.col("t")), signals.product_names(F.col("t"), corrected=True),
        signals.table_ids(F.col("t")), signals.table_ids(F.col("t"), corrected=True),
    ).first()
    assert (row[0], row[1], row[2], row[3]) == (
        [], ["OnTheMap for Emergency Management"], ["2301"], ["S2301", "2301"],
    )
