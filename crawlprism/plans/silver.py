"""Text archives to the silver table of filtered pages."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlprism.functions import text as X
from crawlprism.functions.urls import DEFAULT_TLDS, in_domains
from crawlprism.operators import dictionaries as D
from crawlprism.operators import joins
from crawlprism.operators.language import detect_language
from crawlprism.operators.numbering import with_row_number
from crawlprism.operators.reports import run_summary
from crawlprism.operators.signals import mentions
from crawlprism.schemas import RECORD_COLUMNS
from crawlprism.session import cut_lineage, width_for
from crawlprism.sources import tables
from crawlprism.sources.wet import parse_all, record_scan


def flag_records(
    records: DataFrame,
    keywords: Iterable[str] = D.PRODUCT_KEYWORDS,
    tlds: Iterable[str] = DEFAULT_TLDS,
    min_length: int = 30,
) -> DataFrame:
    """Adds ``clean``, ``kept`` and ``found`` to parsed records.

    Cheap tests come first, so the keyword search runs on kept pages of wanted domains only.
    """
    clean = F.col("parsed") & (F.col("rec_type") != "warcinfo")
    kept = F.col("content_length").try_cast("bigint") > min_length
    keyword = X.let(F.lower("content"), lambda t: mentions(t, keywords))
    flagged = records.withColumn("clean", F.coalesce(clean, F.lit(False)))
    flagged = flagged.withColumn("kept", F.coalesce(F.col("clean") & kept, F.lit(False)))
    return flagged.withColumn(
        "found", F.coalesce(F.col("kept") & in_domains("target_uri", tlds) & keyword, F.lit(False))
    )


def silver_pages(
    records: DataFrame,
    keywords: Iterable[str] = D.PRODUCT_KEYWORDS,
    tlds: Iterable[str] = DEFAULT_TLDS,
    english_only: bool = False,
    **language,
) -> tuple[DataFrame, DataFrame]:
    """Silver pages (record columns, ``lang_status``, ``row_num``) and the one-row run summary.

    The archives are scanned once. Pages that will be dropped keep only their id and
    flags, so the checkpoint and the global numbering carry page text for found pages
    alone. Numbers are assigned before the filters, which leaves gaps, and a record id
    that many records share is spread over tasks. Language runs on found pages, or on
    all kept pages when ``english_only`` makes it a filter.
    """
    flagged = flag_records(records, keywords, tlds)
    if english_only:
        probed = flagged.withColumn("_probe", F.when(F.col("kept"), F.col("content")))
        flagged = detect_language(probed, "_probe", add_bool=False, **language).withColumn(
            "english", F.col("kept") & (F.col("lang_status") == "english_only")
        )
        flagged = flagged.withColumn("found", F.col("found") & F.col("english"))
    payload = [c for c in RECORD_COLUMNS if c != "record_id"]
    extra = ["english", "lang_status"] if english_only else []
    staged = cut_lineage(
        flagged.select(
            "clean",
            "kept",
            "found",
            *extra,
            "record_id",
            *[F.when(F.col("found"), F.col(c)).alias(c) for c in payload],
        )
    )
    numbered = with_row_number(staged.where(F.col("clean")), ["record_id"], partitions=width_for(staged))
    pages = numbered.where(F.col("found"))
    if not english_only:
        pages = detect_language(pages, add_bool=False, **language)
    summary = run_summary(
        staged, F.col("clean"), F.col("kept"), F.col("found"), F.col("english") if english_only else None
    )
    return pages.select(*RECORD_COLUMNS, "lang_status", F.col("row_num").cast("bigint").alias("row_num")), summary


def append_load(records: DataFrame, silver: str, summary: str | None, load_id: str, **kwargs) -> None:
    """Filter parsed records and append the pages and the summary of one load.

    Pages whose record id is already in the table, and the summary of a load that was
    already recorded, are not appended again, so a load can be repeated.
    """
    pages, totals = silver_pages(records, **kwargs)
    tables.append(pages, silver, key="record_id")
    if summary is not None:
        tables.append(totals.withColumn("load_id", F.lit(load_id)), summary, key="load_id")


def wet_to_silver(
    spark: SparkSession,
    paths: str | list[str],
    silver: str,
    summary: str,
    newline: str = "\r\n",
    load_id: str | None = None,
    **kwargs,
) -> int:
    """Read, filter, append pages and summary; returns how many record ids the table holds twice.

    ``load_id`` names the load in the summary; by default it follows from the paths.
    """
    named = [paths] if isinstance(paths, str) else sorted(paths)
    load_id = load_id or "paths:" + hashlib.md5("\n".join(named).encode()).hexdigest()
    append_load(parse_all(record_scan(spark, paths, newline)), silver, summary, load_id, **kwargs)
    return joins.count_duplicate_keys(spark.read.table(silver), "record_id").first()[0]
