"""Silver pages to the gold tables and the reports over them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlprism.operators import dictionaries as D
from crawlprism.operators import ngrams, reports, signals
from crawlprism.operators.features import label_counts
from crawlprism.sources import tables

PUBLISHER_SITE = "census.gov"


def enrich_to_gold(spark: SparkSession, silver: str, gold: str) -> DataFrame:
    """Label and enrich, replace the gold table, return the label counts read back from it."""
    tables.overwrite(signals.label_pages(spark.read.table(silver)), gold)
    return label_counts(spark.read.table(gold))


def domain_reports(gold: DataFrame, label: str = "repackages", top_n: int = 10) -> dict[str, DataFrame]:
    pages = reports.with_site_columns(gold.where(F.col("label") == label))
    return {"tld": reports.counts_by(pages, "tld"), "root_url": reports.counts_by(pages, "root_url", top_n)}


def outside_publisher(gold: DataFrame) -> DataFrame:
    return reports.with_site_columns(gold).where(F.col("root_url") != PUBLISHER_SITE)


def label_ngrams(
    gold: DataFrame,
    ngram_range: tuple[int, int] = (1, 1),
    top_n: int = 25,
    additional_stop_words: Iterable[str] = D.WEB_STOP_WORDS,
) -> DataFrame:
    """Top n-grams of each label outside the publisher's own site."""
    return ngrams.top_ngrams_by(
        outside_publisher(gold),
        "label",
        ngram_range=ngram_range,
        top_n=top_n,
        additional_stop_words=additional_stop_words,
    )


def repackaged_unigrams(gold: DataFrame, top_n: int = 100) -> DataFrame:
    return ngrams.top_ngrams(
        outside_publisher(gold).where(F.col("label") == "repackages"),
        additional_stop_words=D.WEB_STOP_WORDS,
        top_n=top_n,
    )


def save_unigrams(spark: SparkSession, gold: str, target: str, replace: bool = True) -> None:
    counts = repackaged_unigrams(spark.read.table(gold))
    (tables.overwrite if replace else tables.create)(counts, target)


def marts(spark: SparkSession, names: dict[str, str]) -> dict[str, DataFrame]:
    """The tables a dashboard reads, by role; a missing one is an error that names it."""
    missing = [name for name in names.values() if not spark.catalog.tableExists(name)]
    if missing:
        raise ValueError(f"missing tables: {', '.join(sorted(missing))}")
    return {role: spark.read.table(name) for role, name in names.items()}


# The tables a dashboard expects.
DASHBOARD_ROLES = (
    "census_repackaged_enriched",
    "unigrams_repackaged",
    "nlp_pipeline_summary",
    "cleaned_master_crawls_2025",
    "census_product_cleaned",
)
