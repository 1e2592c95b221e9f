"""Domain, site and run reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlprism.functions.urls import root_url, top_level_domain
from crawlprism.operators import dictionaries as D


def with_site_columns(df: DataFrame, uri_col: str = "target_uri") -> DataFrame:
    return df.withColumn("root_url", root_url(uri_col)).withColumn("tld", top_level_domain("root_url"))


def counts_by(df: DataFrame, col: str, top_n: int | None = None) -> DataFrame:
    """Rows per value, largest first; NULL is no value."""
    out = (
        df.where(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), col)
    )
    return out if top_n is None else out.limit(top_n)


def site_rows(df: DataFrame, site: str, uri_col: str = "target_uri", literal: bool = False) -> DataFrame:
    """Rows whose URI contains the site. The site is a regex unless ``literal``: ``.`` matches any character."""
    c = F.col(uri_col)
    return df.where(c.contains(site) if literal else c.rlike(site))


def site_presence(
    df: DataFrame,
    sites: Iterable[str] = D.SITES_OF_INTEREST,
    labels: Iterable[str] = ("cites", "repackages"),
    uri_col: str = "target_uri",
    literal: bool = False,
) -> DataFrame:
    """Pages per site and label; a site without pages is listed with zeros.

    One aggregation row holds all counters, so there is no join and nothing is
    shuffled but that row.
    """
    sites, labels = list(sites), list(labels)

    def on_site(site: str) -> Column:
        return F.col(uri_col).contains(site) if literal else F.col(uri_col).rlike(site)

    # one search per site: the flags come out of a generator, which keeps them from being copied into the counters
    flags = F.struct(F.col("label").alias("label"), *[on_site(site).alias(f"f{i}") for i, site in enumerate(sites)])
    flagged = df.select(F.inline(F.transform(F.array(F.lit(0)), lambda _: flags)))
    counters = {}
    for i, _ in enumerate(sites):
        counters[f"s{i}_all"] = F.count_if(f"f{i}")
        for j, label in enumerate(labels):
            counters[f"s{i}_{j}"] = F.count_if(F.col(f"f{i}") & (F.col("label") == label))
    one = flagged.agg(*[c.alias(name) for name, c in counters.items()])
    lines = [
        F.struct(
            F.lit(site).alias("site"),
            (F.col(f"s{i}_all") > 0).alias("present"),
            *[F.col(f"s{i}_{j}").alias(label) for j, label in enumerate(labels)],
        )
        for i, site in enumerate(sites)
    ]
    return one.select(F.inline(F.array(*lines)))


def run_summary(
    df: DataFrame, parsed: Column, kept: Column, found: Column, english: Column | None = None
) -> DataFrame:
    """One-row summary of a run in one pass over flagged records.

    ``processed`` counts records. ``total_english_records_found`` keeps its historic
    meaning, records that pass the length filter; ``total_english_only`` counts pages
    whose language status is english_only, and is NULL when that was not computed.
    """
    return df.agg(
        F.count_if(found).alias("total_products_found"),
        F.count_if(parsed).alias("total_clean_count"),
        F.count_if(kept).alias("total_english_records_found"),
        F.count(F.lit(1)).alias("total_records_processed"),
        (F.lit(None).cast("bigint") if english is None else F.count_if(english)).alias("total_english_only"),
    )
