"""Catalog of archive objects: listing, prefixes and crawl times."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlprism.functions import text as X

CRAWL_PREFIX = r"^(crawl-data/[^/]+/)"
CRAWL_STAMPS = r"CC-MAIN-(\d{14})-(\d{14})-"


def object_manifest(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """One row per non-empty object below ``path``. Only metadata is read.

    Spark lists the files and keeps their index on the driver, so this is for folders. A whole
    archive publishes path lists and inventories; read those as a table. File scans leave out
    empty objects (folder markers, for example).
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        F.col("path").alias("obj_key"),
        F.col("modificationTime").alias("last_modified"),
        F.col("length").alias("size"),
    )


def as_json(manifest: DataFrame) -> DataFrame:
    return manifest.select(F.to_json(F.struct("*")).alias("json"))


def normalize_prefix(prefix: str) -> str:
    if not isinstance(prefix, str) or not prefix:
        raise ValueError(f"prefix must be a non-empty string, got {prefix!r}")
    return prefix if prefix.endswith("/") else prefix + "/"


def list_crawls(manifest: DataFrame, prefix: str, key_col: str = "obj_key") -> DataFrame:
    """Objects below one prefix; an unknown prefix gives an empty frame."""
    return manifest.where(F.col(key_col).startswith(normalize_prefix(prefix)))


def crawl_prefix(key: Column | str = "obj_key") -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return X.let(F.regexp_extract(key, CRAWL_PREFIX, 1), lambda p: F.when(p != "", p))


def master_indexes(manifest: DataFrame, key_col: str = "obj_key") -> DataFrame:
    """Distinct first-level prefixes."""
    return (
        manifest.select(crawl_prefix(key_col).alias("master_index"))
        .where(F.col("master_index").isNotNull())
        .distinct()
    )


def clean_prefix(c: Column | str) -> Column:
    """Trimmed, with a trailing slash ('' becomes '/')."""
    trimmed = F.trim(F.col(c) if isinstance(c, str) else c)
    return X.let(trimmed, lambda p: F.when(p.endswith("/"), p).otherwise(F.concat(p, F.lit("/"))))


def prefix_list(df: DataFrame, column: str, position: str) -> DataFrame:
    """Distinct clean prefixes in first-seen order; ``position`` holds the input order."""
    return (
        df.select(clean_prefix(column).alias("prefix"), F.col(position).alias("_pos"))
        .where(F.col("prefix").isNotNull())
        .groupBy("prefix")
        .agg(F.min("_pos").alias("first_seen"))
        .orderBy("first_seen", "prefix")
    )


def ancestor_prefixes(key: Column | str = "obj_key") -> Column:
    """Every prefix of a key that ends in a slash, at most one for each level."""
    key = F.col(key) if isinstance(key, str) else key
    parts = F.split(key, "/")
    depth = F.size(parts) - 1
    levels = F.when(depth > 0, F.sequence(F.lit(1), depth)).otherwise(F.array().cast("array<int>"))
    return F.transform(levels, lambda i: F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")))


def ingest_crawls(manifest: DataFrame, prefixes: DataFrame | Iterable[str], key_col: str = "obj_key") -> DataFrame:
    """Objects below any of the prefixes, tagged with the prefix that was asked for.

    A prefix may have any depth. One scan of the manifest replaces a listing per prefix: a key meets
    the prefixes by equality with its own ancestors. An object below two of the prefixes comes once
    for each; prefixes without objects add nothing.
    """
    if isinstance(prefixes, DataFrame):
        wanted = prefixes.select(clean_prefix(prefixes.columns[0]).alias("crawl_prefix")).distinct()
        below = manifest.withColumn("crawl_prefix", F.explode(ancestor_prefixes(key_col)))
        return below.join(wanted, "crawl_prefix", "left_semi").select(*manifest.columns, "crawl_prefix")
    wanted = sorted({normalize_prefix(p.strip()) for p in prefixes})
    if not wanted:
        raise RuntimeError("no crawl prefixes given")
    found = F.array_intersect(ancestor_prefixes(key_col), F.array(*[F.lit(p) for p in wanted]))
    return manifest.withColumn("crawl_prefix", F.explode(found))


def require_rows(df: DataFrame) -> DataFrame:
    """The frame itself, or an error when it has no rows (one-row probe)."""
    if df.isEmpty():
        raise RuntimeError("no data returned to union")
    return df


def with_crawl_times(df: DataFrame, key_col: str = "obj_key") -> DataFrame:
    """Start and end time from the object name; NULL when they do not parse."""

    def stamp(group: int) -> Column:
        return F.try_to_timestamp(F.regexp_extract(key_col, CRAWL_STAMPS, group), F.lit("yyyyMMddHHmmss"))

    return df.withColumns({"crawl_start": stamp(1), "crawl_end": stamp(2)})


def dated_crawls(manifest: DataFrame, kind: str = "wet", key_col: str = "obj_key") -> DataFrame:
    """Objects of one kind whose start time parses, without the checksum column."""
    return (
        with_crawl_times(manifest.where(F.col(key_col).contains(kind)), key_col)
        .where(F.col("crawl_start").isNotNull())
        .drop("checksum_algorithm")
    )


def of_year(df: DataFrame, year: int | str, time_col: str = "crawl_start") -> DataFrame:
    return df.where(F.year(time_col) == int(year))


def basename(c: Column | str) -> Column:
    return F.substring_index(F.col(c) if isinstance(c, str) else c, "/", -1)
