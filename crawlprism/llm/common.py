"""Helpers shared by the operators: whole-batch Arrow maps, table access, safe scratch tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlprism.session import checkpoint_dir

# One Arrow batch holds at most this many rows and about this many bytes, so that long texts
# do not add up in a Python worker.
BATCH_ROWS = 2000
BATCH_BYTES = 8 * 1024 * 1024


def bound_batches(spark: SparkSession) -> None:
    """Session settings that bound what one Arrow batch holds in memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_KEPT: dict = {}


def kept(key: tuple, build: Callable):
    """What a Python worker keeps between tasks: one object, so that the models of several operators do not add up."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = build()
    return _KEPT[key]


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield fn(batch)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def text_bytes(df: DataFrame, text_col: str = "text"):
    """The text as UTF-8 bytes; null is empty."""
    return F.coalesce(F.col(text_col), F.lit("")).cast("binary")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the frame to a table in the shared folder and read it back.

    What follows reads files that every executor reaches, so a lost executor costs no more
    than its running tasks, and two readers see the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
