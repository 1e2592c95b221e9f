"""Metadata-archive (WAT) envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlprism.schemas import WAT_SCHEMA


def json_lines(df: DataFrame, col: str = "value") -> DataFrame:
    """Lines that start with ``{`` and end with ``}``."""
    c = F.col(col)
    return df.where(c.startswith("{") & c.endswith("}"))


def flatten_struct(df: DataFrame) -> DataFrame:
    """Every leaf of nested structs as a top-level column named by its path, ``-`` and ``.`` as ``_``."""

    def leaves(field: T.StructField, path: Column, name: str):
        if isinstance(field.dataType, T.StructType):
            for child in field.dataType.fields:
                yield from leaves(child, path.getField(child.name), f"{name}_{child.name}")
        else:
            yield path.alias(name.replace("-", "_"))

    return df.select(
        *[c for f in df.schema.fields for c in leaves(f, F.col(f"`{f.name}`"), f.name)]
    )


def wat_records(df: DataFrame, col: str = "value") -> DataFrame:
    """Envelope lines to 29 flat columns; a malformed line gives a row of NULLs."""
    parsed = json_lines(df, col).select(F.from_json(col, WAT_SCHEMA).alias("doc"))
    return flatten_struct(parsed.select("doc.*"))


def wat_scan(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return wat_records(spark.read.text(paths))
