"""Text-archive (WET) records: one row per page, in one pass and without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlprism.functions import text as X
from crawlprism.schemas import RECORD_COLUMNS

_LENGTH = r"Content-Length:\s*(\d+)"
_LENGTH_THEN_BLANK = r"\nContent-Length:\s*\d+\s*\n\n"
_LENGTH_LAST = r"\nContent-Length:\s*\d+\s*\z"

HEADERS = {
    "rec_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "warc_date": "WARC-Date",
    "record_id": "WARC-Record-ID",
    "refers_to": "WARC-Refers-To",
    "warc_filename": "WARC-Filename",
    "is_part_of": "isPartOf",
    "block_digest": "WARC-Block-Digest",
    "content_language": "WARC-Identified-Content-Language",
    "content_type": "Content-Type",
}


def record_separator(newline: str = "\r\n") -> str:
    """The marker line between two records. Only marker lines ended by ``newline`` separate."""
    return f"\nWARC/1.0{newline}"


def record_scan(spark: SparkSession, paths: str | list[str], newline: str = "\r\n") -> DataFrame:
    """One row per archive record, plain or gzipped.

    The separator does the grouping inside the reader. A gzip file is read by one
    task, so parallelism is the number of files; repartition after filtering, not here.
    """
    return spark.read.option("lineSep", record_separator(newline)).text(paths)


def record_stream(spark: SparkSession, path: str, newline: str = "\r\n", **options: str) -> DataFrame:
    return spark.readStream.option("lineSep", record_separator(newline)).options(**options).text(path)


def line_scan(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per line."""
    return spark.read.text(paths)


def header(block: Column, name: str, strict: bool = False) -> Column:
    """First value of a header; NULL when absent.

    By default an empty header takes the following line as its value and the name
    may start anywhere in a line. ``strict`` anchors the name and stays on its line.
    """
    quoted = name.replace("-", r"\-")
    if strict:
        pattern = rf'(?md)^{quoted}:[ \t]*"?([^"\n]+?)"?[ \t]*$'
    else:
        pattern = rf'(?md){quoted}:\s*"?([^"\n]+?)"?\s*$'
    return X.strip(F.get(F.regexp_extract_all(block, F.lit(pattern), 1), 0))


def _unix_lines(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def parse_all(
    df: DataFrame, text_col: str = "value", keep: list[str] | None = None, strict_headers: bool = False
) -> DataFrame:
    """Every record text with ``parsed`` and the 12 record columns (NULL when it does not parse).

    A record parses when its Content-Length is the last header, followed by a blank
    line. That test and the headers look at the text before the first blank line
    only; records of another form are cut with one regex over the whole text.
    """
    keep = keep or []

    def cut_head(text: Column) -> Column:
        return F.struct(text.alias("_text"), F.substring_index(text, "\n\n", 1).alias("_head"))

    # a generator, because filters on the headers must not copy the text clean-up below themselves
    text = F.concat(F.lit("\n"), _unix_lines(F.col(text_col)))
    parts = df.select(*keep, F.inline(F.transform(F.array(text), cut_head)))
    cut = F.split("_text", _LENGTH_THEN_BLANK, 2)
    # a record that breaks off within its headers has no blank line and does not parse
    regular = F.col("_head").rlike(_LENGTH_LAST) & F.contains("_text", F.lit("\n\n"))
    block = F.when(regular, F.regexp_replace("_head", _LENGTH_LAST, "")).when(
        F.size(cut) > 1, F.get(cut, 0)
    )
    length = F.regexp_extract(F.when(regular, F.col("_head")).otherwise(F.col("_text")), _LENGTH, 1)
    body = F.when(regular, F.substr("_text", F.length("_head") + 1)).when(F.size(cut) > 1, F.get(cut, 1))
    found = parts.select(
        *keep,
        block.alias("_block"),
        F.nullif(length, F.lit("")).alias("_length"),
        body.alias("_body"),
    )
    full_block = F.concat("_block", F.lit("\nContent-Length: "), "_length")
    return (
        found.withColumn("_headers", full_block)
        .withColumns({name: header(F.col("_headers"), h, strict_headers) for name, h in HEADERS.items()})
        .withColumns(
            {
                "content_length": F.when(F.col("_block").isNotNull(), F.col("_length")),
                "content": X.strip("_body"),
            }
        )
        .select(*keep, F.col("_block").isNotNull().alias("parsed"), *RECORD_COLUMNS)
    )


def parse_records(
    df: DataFrame,
    text_col: str = "value",
    keep: list[str] | None = None,
    drop_type: str | None = "warcinfo",
    strict_headers: bool = False,
) -> DataFrame:
    """Records that parse, without ``drop_type`` and untyped ones; ``keep`` carries columns along."""
    records = parse_all(df, text_col, keep, strict_headers).where(F.col("parsed")).drop("parsed")
    return records if drop_type is None else records.where(F.col("rec_type") != drop_type)


def wet_records(spark: SparkSession, paths: str | list[str], newline: str = "\r\n", **kwargs) -> DataFrame:
    """Record scan and parse: archive files to page rows."""
    return parse_records(record_scan(spark, paths, newline), **kwargs)


def longer_than(df: DataFrame, minimum: int = 30, col: str = "content_length") -> DataFrame:
    """Numeric test on the textual length; text that is no integer fails it."""
    return df.where(F.col(col).try_cast("bigint") > minimum)
