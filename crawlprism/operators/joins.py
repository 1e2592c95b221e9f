"""Rows whose key has not been seen yet, unions and duplicate keys."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _distinct_in_tags(df: DataFrame, key: str, tags: int = 16) -> DataFrame:
    """At most ``tags`` copies of each key, without bringing all copies of one key together.

    Tagged by input partition, a hot key is reduced on the map side and in ``tags`` places.
    """
    tagged = df.select(F.col(key).cast("string").alias("_key"), F.pmod(F.spark_partition_id(), F.lit(tags)).alias("_tag"))
    return tagged.where(F.col("_key").isNotNull()).distinct().select("_key")


def exclude_seen(df: DataFrame, seen: DataFrame, key: str = "obj_key") -> DataFrame:
    """Left anti join on ``key``; rows with a NULL key are kept.

    Hot keys on either side do not make one task. The seen side is pre-aggregated. It is
    then shuffled directly for the join, which lets adaptive execution split an oversized
    partition of the left side. NULL keys never match: they join on a second column that no
    seen row carries and are spread by their input partition.
    """
    # always -1, but no literal: a constant would be folded out of the join keys
    never = F.least(F.length("_key"), F.lit(-1))
    keys = _distinct_in_tags(seen, key).withColumn("_spread", never)
    routed = df.withColumns(
        {
            "_key": F.coalesce(F.col(key).cast("string"), F.lit("")),
            "_spread": F.when(F.col(key).isNull(), F.spark_partition_id()).otherwise(F.lit(-1)),
        }
    )
    matches = [routed["_key"] == keys["_key"], routed["_spread"] == keys["_spread"]]
    return routed.join(keys, matches, "left_anti").select(*[f"`{c}`" for c in df.columns])


def new_rows(df: DataFrame, seen: DataFrame, key: str, columns: Iterable[str]) -> DataFrame:
    """Only unseen keys, projected to the columns of the target table."""
    return exclude_seen(df.select(*columns), seen, key)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name; columns a frame lacks become NULL. An error when there is no frame."""
    frames = list(frames)
    if not frames:
        raise RuntimeError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def duplicate_keys(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Keys seen more than once, with their count."""
    keys = [key] if isinstance(key, str) else key
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def count_duplicate_keys(df: DataFrame, key: str | list[str], out_col: str = "duplicate_keys") -> DataFrame:
    return duplicate_keys(df, key).agg(F.count(F.lit(1)).alias(out_col))
