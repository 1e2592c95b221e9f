"""Catalog loads: master index, crawl listings and the WET sample."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlprism.operators import joins, sampling
from crawlprism.schemas import MANIFEST_COLUMNS
from crawlprism.sources import manifest as M
from crawlprism.sources import tables


def load_master_index(manifest: DataFrame, bronze: str, silver: str, year: str = "2025") -> None:
    """All prefixes to bronze, one year's prefixes to silver."""
    spark = manifest.sparkSession
    tables.overwrite(M.master_indexes(manifest), bronze)
    indexes = spark.read.table(bronze)
    tables.overwrite(indexes.where(F.col("master_index").contains(year)), silver)


def _listing(manifest: DataFrame, prefixes: DataFrame | Iterable[str]) -> DataFrame:
    listing = M.require_rows(M.ingest_crawls(manifest, prefixes))
    return listing.select(*[c for c in MANIFEST_COLUMNS if c in listing.columns])


def ingest_prefixes(manifest: DataFrame, prefix_table: str, target: str) -> None:
    """Replace the target with the objects below the listed prefixes."""
    prefixes = manifest.sparkSession.read.table(prefix_table).select("master_index")
    tables.overwrite(_listing(manifest, prefixes), target)


def backfill(manifest: DataFrame, prefix_table: str, target: str, years: Iterable[int | str]) -> None:
    """Append several years. A year named twice, or already loaded, adds nothing."""
    indexes = manifest.sparkSession.read.table(prefix_table).select("master_index")
    wanted = F.lit(False)
    for year in years:
        wanted = wanted | F.col("master_index").contains(str(year))
    tables.append(_listing(manifest, indexes.where(wanted)), target, key="obj_key")


def ingest_latest(manifest: DataFrame, prefix_table: str, target: str) -> dict[str, int]:
    """Add the unseen objects of the newest crawl; returns its row and duplicate-key counts."""
    spark = manifest.sparkSession
    newest = sampling.latest(spark.read.table(prefix_table), "master_index")
    recent = M.list_crawls(manifest, newest).withColumn("crawl_prefix", F.lit(newest))
    per_key = recent.groupBy("obj_key").agg(F.count(F.lit(1)).alias("n"))
    counts = per_key.agg(F.sum("n").alias("rows"), F.count_if(F.col("n") > 1).alias("duplicates")).first()
    columns = [c for c in MANIFEST_COLUMNS if c in recent.columns]
    tables.upsert_new(recent, target, "obj_key", columns)
    return {"rows": counts["rows"] or 0, "duplicate_keys": counts["duplicates"]}


def unsampled_crawls(spark: SparkSession, crawls: str, sampled: str | None, kind: str = "wet") -> DataFrame:
    """Dated objects of one kind that no earlier run has sampled."""
    dated = M.dated_crawls(spark.read.table(crawls), kind)
    if sampled and spark.catalog.tableExists(sampled):
        dated = joins.exclude_seen(dated, spark.read.table(sampled), "obj_key")
    return dated


def sample_to_table(
    spark: SparkSession, crawls: str, sampled: str, years: Iterable[int | str], limit: int = 2
) -> None:
    """Append the earliest unsampled crawls of each year to the sample table."""
    tables.append(sampling.sample_crawls(unsampled_crawls(spark, crawls, sampled), years, limit), sampled)
