"""Per-year samples, the newest value and the reproducible train/test split."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_group(df: DataFrame, group: list[Column | str], order: list[Column | str], k: int = 1) -> DataFrame:
    """First ``k`` rows of each group.

    The filter on row_number plans as a WindowGroupLimit: each task keeps at most
    ``k`` rows per group before the shuffle, so a huge group arrives small.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= k).drop("_rn")


def sample_crawls(
    df: DataFrame,
    years: Iterable[int | str] | None = None,
    limit: int = 2,
    time_col: str = "crawl_start",
    key_col: str = "obj_key",
) -> DataFrame:
    """The ``limit`` earliest crawls of each year, in one window instead of a job per year."""
    dated = df.withColumn("crawl_year", F.year(time_col))
    if years is not None:
        dated = dated.where(F.col("crawl_year").isin([int(y) for y in years]))
    return first_per_group(dated, ["crawl_year"], [time_col, key_col], limit).drop("crawl_year")


def pick_per_year(
    df: DataFrame,
    kind: str,
    years: Iterable[int | str] | None = None,
    time_col: str = "last_modified",
    key_col: str = "obj_key",
    k: int = 1,
) -> DataFrame:
    """``k`` pseudo-random objects of one kind per year, the same ones on every run."""
    dated = df.where(F.col(key_col).contains(kind)).withColumn("crawl_year", F.year(time_col))
    if years is not None:
        dated = dated.where(F.col("crawl_year").isin([int(y) for y in years]))
    return first_per_group(dated, ["crawl_year"], [F.md5(key_col), key_col], k).drop("crawl_year")


def latest(df: DataFrame, col: str) -> str:
    """Largest value of a column as a scalar; an error when there is none."""
    value = df.agg(F.max(col)).first()[0]
    if value is None:
        raise ValueError(f"no value in column {col!r}")
    return value


def hash_bucket(key: Column | str, buckets: int = 100) -> Column:
    """Stable bucket of a key, the same in every engine that has md5."""
    key = F.col(key) if isinstance(key, str) else key
    head = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets))


def split_by_key(df: DataFrame, key: str, train_share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; a row's side depends on its key only, not on partitioning."""
    in_train = hash_bucket(key) < int(round(train_share * 100))
    return df.where(in_train), df.where(~in_train)
