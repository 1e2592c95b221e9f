"""Frames the registered queries run on, derived from the supplied tables.

The supplied texts hold no statistics vocabulary, so known signals are appended.
Each Spark builder has a SQL twin (``*_SQL``) that yields the same rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlprism.session import checkpoint_dir

PHRASES = [
    "american community survey",
    "see data.census.gov and api.census.gov",
    "table S0101 and tables B19013_MOE",
    "DP02 CP03 margin of error",
    "county business patterns (cbp)",
    "pl 94-171 redistricting data",
    "p.l. 94–171 file",
    "tiger/line shapefiles",
    "census tracts and block groups",
    "source: u.s. census bureau",
    "according to the us census bureau",
    "from the U. S. Census Bureau",
    "census 2020 decennial census",
    "the census of agriculture",
    "pums api microdata api",
    "on the map lehd lodes",
    "fips codes gazetteer",
    "economic census census of governments",
    "puma ZCTA CBSA",
    "cps sipp ahs acs ACS",
    "summary file 1",
    "long form",
    "bds",
    "lbd",
    "incorporated places",
    "data profiles",
]


def load(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    table = spark.read.parquet(f"{sf}/{name}.parquet")
    return table.select(*columns) if columns else table


def _pick(position: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), position.cast("int") + 1)


# --- pages with signals -------------------------------------------------------------


def salted(spark: SparkSession, sf: str) -> DataFrame:
    d = load(spark, sf, "documents", "doc_id", "lang", "text")
    kind = F.col("doc_id") % 10
    copies = F.greatest(F.lit(5), F.floor(F.length("text") / 20).cast("int"))
    tail = (
        F.when(kind == 0, " Source: U.S. Census Bureau")
        .when(kind == 1, " see data.census.gov for tables")
        .when(
            kind == 2,
            F.concat(F.lit(" figures by census bureau "), F.repeat(F.lit("1234567890 "), copies)),
        )
        .when(kind == 3, " American  Community Survey table S0101 and B19013_MOE")
        .when(kind == 4, " the census of agriculture")
        .otherwise("")
    )
    return d.select("doc_id", "lang", F.concat("text", tail).alias("content"))


SALTED_SQL = """salted AS (
  SELECT doc_id, lang, text || CASE doc_id % 10
    WHEN 0 THEN ' Source: U.S. Census Bureau'
    WHEN 1 THEN ' see data.census.gov for tables'
    WHEN 2 THEN ' figures by census bureau ' ||
         repeat('1234567890 ', greatest(5, CAST(floor(length(text) / 20) AS INT)))
    WHEN 3 THEN ' American  Community Survey table S0101 and B19013_MOE'
    WHEN 4 THEN ' the census of agriculture'
    ELSE '' END AS content
  FROM documents)"""


def phrased(spark: SparkSession, sf: str) -> DataFrame:
    """Every document followed by one of the phrases, so that each pattern occurs."""
    d = load(spark, sf, "documents", "doc_id", "text")
    phrase = _pick(F.col("doc_id") % len(PHRASES), PHRASES)
    return d.select("doc_id", F.concat_ws(" ", "text", phrase, F.lit("end")).alias("content"))


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


PHRASED_SQL = f"""phrased AS (
  SELECT doc_id, text || ' ' || list_extract({sql_list(PHRASES)}, CAST(doc_id % {len(PHRASES)} AS INT) + 1)
         || ' end' AS content
  FROM documents)"""


def page_urls(spark: SparkSession, sf: str) -> DataFrame:
    """The URLs of ``pages``, some of them on the publisher's own site and some with a port."""
    number = F.col("page_id").cast("string")
    url = (
        F.when(F.col("page_id") % 9 == 4, F.concat(F.lit("https://www.census.gov/data/"), number))
        .when(F.col("page_id") % 9 == 7, F.concat(F.lit("http://host.example.com:8080/"), number))
        .otherwise(F.col("url"))
    )
    return load(spark, sf, "pages", "page_id", "url").select("page_id", url.alias("url"))


PAGE_URLS_SQL = """page_urls AS (
  SELECT page_id, CASE page_id % 9 WHEN 4 THEN 'https://www.census.gov/data/' || page_id
    WHEN 7 THEN 'http://host.example.com:8080/' || page_id ELSE url END AS url FROM pages)"""


def mixed_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The documents, some of them with a tail in another script."""
    tail = F.when(F.col("doc_id") % 11 == 6, " Это русский текст").otherwise("")
    return load(spark, sf, "documents", "doc_id", "lang", "text").select("doc_id", "lang", F.concat("text", tail).alias("text"))


MIXED_SQL = """mixed AS (
  SELECT doc_id, lang, text || CASE WHEN doc_id % 11 = 6 THEN ' Это русский текст' ELSE '' END AS text FROM documents)"""


def _on_pages(spark: SparkSession, sf: str, docs: DataFrame) -> DataFrame:
    """Each document placed on one of the URLs of ``pages``."""
    p = page_urls(spark, sf)
    n_pages = p.agg(F.count(F.lit(1))).scalar()
    return docs.withColumn("page_id", F.col("doc_id") % n_pages).join(p, "page_id")


def _record_id() -> Column:
    return F.concat(F.lit("<urn:uuid:"), F.col("doc_id").cast("string"), F.lit(">"))


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Salted pages with URLs."""
    return _on_pages(spark, sf, salted(spark, sf)).select(
        _record_id().alias("record_id"),
        F.col("url").alias("target_uri"),
        F.col("lang").alias("content_language"),
        "content",
    )


CORPUS_SQL = f"""{SALTED_SQL}, {PAGE_URLS_SQL}, corpus AS (
  SELECT '<urn:uuid:' || s.doc_id || '>' AS record_id, p.url AS target_uri,
         s.lang AS content_language, s.content
  FROM salted s JOIN page_urls p ON p.page_id = s.doc_id % (SELECT count(*) FROM pages))"""

NORM = r"trim(regexp_replace(lower(content), '\s+', ' ', 'g'))"


def labelled_sql(source: str, columns: str) -> str:
    """``norm`` and ``labelled`` over a page relation: the label rule written out in SQL."""
    return rf"""norm AS (
  SELECT {columns}, {NORM} AS text_norm FROM {source}),
scored AS (
  SELECT *, regexp_matches(text_norm,
           '(source\s*:\s*(the\s+)?u\.?\s*s\.?\s*census\s*bureau)|'
           || '(according\s+to\s+(the\s+)?u\.?\s*s\.?\s*census\s*bureau)|'
           || '(from\s+(the\s+)?u\.?\s*s\.?\s*census\s*bureau)') AS credited,
         regexp_matches(text_norm, '\b(census\.gov|data\.census\.gov|api\.census\.gov|factfinder\.census\.gov)\b')
         OR regexp_matches(text_norm, '\b(data\.census\.gov|api\.census\.gov|factfinder|american\s+factfinder)\b')
         OR regexp_matches(text_norm, '\b(microdata\s*api|pums\s*api)\b') AS linked,
         length(regexp_replace(text_norm, '[^0-9]', '', 'g')) / length(text_norm) AS num_density
  FROM norm WHERE length(text_norm) > 100),
labelled AS (
  SELECT *, CASE WHEN credited OR linked THEN 'cites' WHEN num_density > 0.12 THEN 'repackages' END AS label
  FROM scored)"""


# --- archive records ------------------------------------------------------------------


def record_texts(spark: SparkSession, sf: str, with_signals: bool = False) -> DataFrame:
    """Archive record texts as the record scan returns them (CRLF headers).

    One page record per document, and one warcinfo record per page row. ``doc_id`` is
    negative on the latter.
    """
    if with_signals:
        docs = salted(spark, sf)
    else:
        docs = load(spark, sf, "documents", "doc_id", "lang", "text").withColumnRenamed("text", "content")
    lines = [
        F.lit("WARC-Type: conversion"),
        F.concat(F.lit("WARC-Target-URI: "), "url"),
        F.lit("WARC-Date: 2024-01-01T00:00:00Z"),
        F.concat(F.lit("WARC-Record-ID: "), _record_id()),
        F.concat(F.lit("WARC-Identified-Content-Language: "), "lang"),
        F.lit("Content-Type: text/plain"),
        F.concat(F.lit("Content-Length: "), F.octet_length("content").cast("string")),
        F.lit(""),
        F.col("content"),
    ]
    info = F.concat(
        F.lit("WARC-Type: warcinfo\r\nWARC-Filename: f"),
        F.col("page_id").cast("string"),
        F.lit(".warc.wet.gz\r\nContent-Type: application/warc-fields\r\nContent-Length: 7\r\n\r\nrobots: \r\n"),
    )
    pages = _on_pages(spark, sf, docs).select("doc_id", F.concat_ws("\r\n", *lines, F.lit("")).alias("value"))
    heads = load(spark, sf, "pages", "page_id").select((-F.col("page_id") - 1).alias("doc_id"), info.alias("value"))
    return pages.unionAll(heads)


def archive_folder(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/wet-{uuid.uuid4().hex}"


def scratch_database(spark: SparkSession) -> str:
    """A new database below the shared checkpoint folder, for queries that load tables and read them back."""
    name = f"load_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{checkpoint_dir(spark).rstrip('/')}/{name}'")
    return name


# --- metadata envelopes ---------------------------------------------------------------


def envelope_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON envelope per page, plus for each page a marker line and a malformed line."""
    p = load(spark, sf, "pages", "page_id", "url", "html")
    size = F.length("html").cast("string")
    meta = F.named_struct(
        F.lit("Deflate-Length"), F.lit("100"), F.lit("Header-Length"), F.lit("10"),
        F.lit("Footer-Length"), F.lit("8"), F.lit("Inflated-CRC"), F.lit("7"),
        F.lit("Inflated-Length"), size,
    )
    container = F.named_struct(
        F.lit("Filename"), F.concat(F.lit("f"), F.col("page_id").cast("string"), F.lit(".warc.gz")),
        F.lit("Compressed"), F.lit(True),
        F.lit("Offset"), F.col("page_id").cast("string"),
        F.lit("Gzip-Metadata"), meta,
    )
    info = F.named_struct(
        F.lit("isPartOf"), F.lit("CC-MAIN-2024-10"), F.lit("publisher"), F.lit("p"),
        F.lit("description"), F.lit("d"), F.lit("operator"), F.lit("o"), F.lit("hostname"), F.lit("h"),
        F.lit("software"), F.lit("s"), F.lit("robots"), F.lit("r"), F.lit("format"), F.lit("WARC"),
    )
    payload = F.named_struct(
        F.lit("Actual-Content-Length"), size, F.lit("Trailing-Slop-Length"), F.lit("0"),
        F.lit("Block-Digest"), F.md5("html"), F.lit("Headers-Corrupt"), F.lit(False),
        F.lit("Actual-Content-Type"), F.lit("text/html"), F.lit("WARC-Info-Metadata"), info,
    )
    header = F.named_struct(
        F.lit("WARC-Type"), F.lit("response"), F.lit("WARC-Date"), F.lit("2024-01-01T00:00:00Z"),
        F.lit("WARC-Record-ID"), F.concat(F.lit("<urn:uuid:"), F.col("page_id").cast("string"), F.lit(">")),
        F.lit("Content-Length"), size, F.lit("Content-Type"), F.lit("application/http"),
    )
    envelope = F.named_struct(
        F.lit("Payload-Metadata"), payload, F.lit("Format"), F.lit("WARC"),
        F.lit("WARC-Header-Length"), F.lit("300"), F.lit("WARC-Header-Metadata"), header,
    )
    doc = F.to_json(F.named_struct(F.lit("Container"), container, F.lit("Envelope"), envelope))
    bad = F.concat(F.lit("{bad "), F.col("page_id").cast("string"), F.lit("}"))
    return p.select(F.explode(F.array(F.lit("WARC/1.0"), doc, bad)).alias("value"))


# --- object catalog -----------------------------------------------------------------------


def crawl_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Objects of seven years; ``seen`` marks those an earlier load already took."""
    o = load(spark, sf, "orders", "o_orderkey", "o_orderdate", "o_orderstatus")
    key = F.col("o_orderkey")
    end = F.col("o_orderdate") + F.expr("interval 3 hours")

    def stamp(c: Column) -> Column:
        return F.date_format(c, "yyyyMMddHHmmss")

    obj_key = F.concat(
        F.lit("crawl-data/CC-MAIN-"),
        F.date_format("o_orderdate", "yyyy-MM"),
        F.lit("/segments/"),
        (key % 100).cast("string"),
        F.lit("/"),
        F.when(key % 4 == 0, "wat").when(key % 4 == 1, "warc").otherwise("wet"),
        F.lit("/CC-MAIN-"),
        F.when(key % 50 == 3, "99999999999999").otherwise(stamp(F.col("o_orderdate"))),
        F.lit("-"),
        stamp(end),
        F.lit("-"),
        key.cast("string"),
        F.when(key % 4 == 0, ".warc.wat.gz").when(key % 4 == 1, ".warc.gz").otherwise(".warc.wet.gz"),
    )
    return o.select(
        "o_orderkey",
        (F.col("o_orderstatus") == "F").alias("seen"),
        obj_key.alias("obj_key"),
        F.col("o_orderdate").cast("timestamp").alias("last_modified"),
        F.md5(obj_key).alias("etag"),
        (key * 100).alias("size"),
        F.lit("STANDARD").alias("storage_class"),
        F.array(F.lit("CRC32")).alias("checksum_algorithm"),
    )


MANIFEST_SQL = """manifest AS (
  SELECT o_orderkey, o_orderstatus = 'F' AS seen,
         'crawl-data/CC-MAIN-' || strftime(o_orderdate, '%Y-%m') || '/segments/' || (o_orderkey % 100) || '/' ||
         CASE o_orderkey % 4 WHEN 0 THEN 'wat' WHEN 1 THEN 'warc' ELSE 'wet' END || '/CC-MAIN-' ||
         CASE WHEN o_orderkey % 50 = 3 THEN '99999999999999' ELSE strftime(o_orderdate, '%Y%m%d%H%M%S') END ||
         '-' || strftime(o_orderdate + INTERVAL 3 HOUR, '%Y%m%d%H%M%S') || '-' || o_orderkey ||
         CASE o_orderkey % 4 WHEN 0 THEN '.warc.wat.gz' WHEN 1 THEN '.warc.gz' ELSE '.warc.wet.gz' END AS obj_key,
         o_orderdate AS last_modified, o_orderkey * 100 AS size
  FROM orders),
dated AS (
  SELECT *, regexp_extract(obj_key, '^(crawl-data/[^/]+/)', 1) AS crawl_prefix,
         try_strptime(regexp_extract(obj_key, 'CC-MAIN-(\\d{14})-(\\d{14})-', 1), '%Y%m%d%H%M%S') AS crawl_start,
         try_strptime(regexp_extract(obj_key, 'CC-MAIN-(\\d{14})-(\\d{14})-', 2), '%Y%m%d%H%M%S') AS crawl_end
  FROM manifest)"""
