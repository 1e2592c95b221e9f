"""Catalog tables: scans and the write modes the loads use."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlprism.operators.joins import exclude_seen

# A batch of more partitions of its target is not traced by their names.
MAX_PARTITIONS = 1000


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def rows(spark: SparkSession, values: Iterable[tuple], schema: str) -> DataFrame:
    """Literal rows."""
    return spark.createDataFrame(list(values), schema)


def within_reach(seen: DataFrame, batch: DataFrame, key: str, partition: str | None = None) -> DataFrame:
    """The rows of ``seen`` that can share a key with the batch.

    The batch's least and greatest key bound the target's scan, so row groups that lie outside are not read. ``partition`` names a
    column of both that follows from the key, such as a crawl: partitions that the batch does not touch are then not listed
    or read. The driver gets two keys and at most MAX_PARTITIONS names; a batch of more partitions is bounded by its keys alone.
    """
    names = batch.select(F.col(partition).alias("p")).distinct().limit(MAX_PARTITIONS + 1).collect() if partition else []
    least, greatest = batch.agg(F.min(key), F.max(key)).first()
    if least is None:
        return seen.limit(0)
    seen = seen.where(F.col(key).between(least, greatest))
    if partition and len(names) <= MAX_PARTITIONS:
        known = [r["p"] for r in names if r["p"] is not None]
        wanted = F.col(partition).isin(known) if known else F.lit(False)
        seen = seen.where(wanted | F.col(partition).isNull() if len(known) < len(names) else wanted)
    return seen


def append(df: DataFrame, name: str, key: str | None = None, partition: str | None = None) -> None:
    """Append; with ``key``, rows the table already has are left out, so a re-run adds nothing.

    Of the table, only what lies within the batch's reach is read. With ``partition``, a new table is partitioned by
    that column; batches are sorted by key, so that later loads can pass over most of their row groups.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    if key and exists:
        df = exclude_seen(df, within_reach(spark.read.table(name), df, key, partition), key)
    if key:
        df = df.sortWithinPartitions(*([partition] if partition else []), key)
    writer = df.write.mode("append")
    (writer.partitionBy(partition) if partition else writer).saveAsTable(name)


def overwrite(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)


def create(df: DataFrame, name: str) -> None:
    """Fails when the table exists."""
    df.write.mode("errorifexists").saveAsTable(name)


def upsert_new(df: DataFrame, name: str, key: str, columns: Iterable[str], partition: str | None = None) -> None:
    """Add rows with unseen keys. Appending the delta equals rewriting the union of both."""
    append(df.select(*columns), name, key, partition)
