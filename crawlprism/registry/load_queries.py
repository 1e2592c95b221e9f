"""Loads that write tables and are read back: catalog, silver and gold pipelines, and the streams.

Every query loads tables of a new database below the shared checkpoint folder, some of it twice, and returns what they hold.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlprism.operators import signals
from crawlprism.plans import catalog, gold, silver
from crawlprism.registry.archive_queries import PLACED_SQL
from crawlprism.registry.base import registry
from crawlprism.registry.catalog_queries import STAMP, WITH
from crawlprism.registry.fixtures import archive_folder, corpus, crawl_manifest, record_texts, scratch_database
from crawlprism.registry.text_queries import LABELLED, OUTSIDE, STOP_WEB, ngram_sql
from crawlprism.schemas import MANIFEST_COLUMNS
from crawlprism.sources import gzip_members, tables
from crawlprism.sources import manifest as M
from crawlprism.streaming import ingest


@registry.add(
    "load_master_index",
    f"{WITH} SELECT DISTINCT crawl_prefix AS master_index FROM dated WHERE contains(crawl_prefix, '1997')",
)
def _(spark, sf):
    db = scratch_database(spark)
    for _ in range(2):  # the second load replaces the first
        catalog.load_master_index(crawl_manifest(spark, sf), f"{db}.bronze", f"{db}.silver", "1997")
    return spark.read.table(f"{db}.silver")


@registry.add(
    "load_backfill",
    f"""{WITH} SELECT obj_key, size, crawl_prefix FROM dated
        WHERE contains(crawl_prefix, '1996') OR contains(crawl_prefix, '1997')""",
)
def _(spark, sf):
    db, m = scratch_database(spark), crawl_manifest(spark, sf)
    tables.overwrite(M.master_indexes(m), f"{db}.prefixes")
    for years in ([1996], [1997, 1996]):  # the year that is there already adds nothing
        catalog.backfill(m, f"{db}.prefixes", f"{db}.crawls", years)
    return spark.read.table(f"{db}.crawls").select("obj_key", "size", "crawl_prefix")


@registry.add(
    "load_unseen_objects",
    f"{WITH} SELECT obj_key, size, crawl_prefix FROM dated",
)
def _(spark, sf):
    # the objects already seen, then all: the second load reads only the part of the table that its keys can meet
    db = scratch_database(spark)
    m = crawl_manifest(spark, sf).withColumn("crawl_prefix", M.crawl_prefix("obj_key"))
    columns = ["obj_key", "size", "crawl_prefix"]
    for batch in (m.where("seen"), m):
        tables.upsert_new(batch, f"{db}.crawls", "obj_key", columns, partition="crawl_prefix")
    return spark.read.table(f"{db}.crawls").select(*columns)


@registry.add(
    "load_latest",
    f"""{WITH} SELECT obj_key, size FROM dated
        WHERE (seen AND contains(crawl_prefix, '1997')) OR starts_with(obj_key, (SELECT max(crawl_prefix) FROM dated))""",
)
def _(spark, sf):
    db, m = scratch_database(spark), crawl_manifest(spark, sf)
    tables.overwrite(M.master_indexes(m), f"{db}.prefixes")
    with_prefix = m.withColumn("crawl_prefix", M.crawl_prefix("obj_key"))
    tables.create(with_prefix.where("seen AND crawl_prefix LIKE '%1997%'").select(*MANIFEST_COLUMNS), f"{db}.crawls")
    for _ in range(2):
        catalog.ingest_latest(m, f"{db}.prefixes", f"{db}.crawls")
    return spark.read.table(f"{db}.crawls").select("obj_key", "size")


@registry.add(
    "load_samples",
    f"""{WITH}, ranked AS (
        SELECT obj_key, crawl_start, row_number() OVER (PARTITION BY year(crawl_start) ORDER BY crawl_start, obj_key) AS rn
        FROM dated WHERE contains(obj_key, 'wet') AND crawl_start IS NOT NULL)
        SELECT obj_key, strftime(crawl_start, '{STAMP}') AS crawl_start FROM ranked
        WHERE rn <= 4 AND year(crawl_start) BETWEEN 1995 AND 1997""",
)
def _(spark, sf):
    db = scratch_database(spark)
    tables.overwrite(crawl_manifest(spark, sf), f"{db}.crawls")
    for _ in range(2):  # the second run takes the next two of each year
        catalog.sample_to_table(spark, f"{db}.crawls", f"{db}.samples", ["1995", "1996", "1997"], limit=2)
    start = F.date_format("crawl_start", "yyyy-MM-dd HH:mm:ss").alias("crawl_start")
    return spark.read.table(f"{db}.samples").select("obj_key", start)


_FOUND_SQL = rf"""WITH {PLACED_SQL} SELECT '<urn:uuid:' || doc_id || '>' AS record_id, url AS target_uri FROM placed
    WHERE octet_length(encode(text)) > 30 AND regexp_matches(lower(text), 'the|le')
      AND regexp_matches(url, '://[^/]*\.(com|org|net|gov)(/|$)')"""

_ANYWHERE = ["com", "org", "net", "gov"]


@registry.add("load_silver", _FOUND_SQL)
def _(spark, sf):
    # archives on disk, loaded twice under one name
    db = scratch_database(spark)
    files = gzip_members.write_archives(record_texts(spark, sf), archive_folder(spark))
    paths = [r["path"] for r in files.collect()]
    for _ in range(2):
        silver.wet_to_silver(spark, paths, f"{db}.pages", f"{db}.runs", keywords=["the", "le"], tlds=_ANYWHERE)
    return spark.read.table(f"{db}.pages").select("record_id", "target_uri")


@registry.add("stream_silver", _FOUND_SQL)
def _(spark, sf):
    db, folder = scratch_database(spark), archive_folder(spark)
    gzip_members.write_archives(record_texts(spark, sf), folder)
    for _ in range(2):  # the second run finds no new file
        query = ingest.ingest_wet(spark, folder, f"{db}.pages", f"{folder}-progress", summary=f"{db}.runs", keywords=["the", "le"], tlds=_ANYWHERE)
        query.awaitTermination()
    return spark.read.table(f"{db}.pages").select("record_id", "target_uri")


@registry.add("stream_manifest", f"{WITH} SELECT obj_key, size FROM dated")
def _(spark, sf):
    return _listed_twice(spark, sf)


@registry.add("stream_manifest_remembered", f"{WITH} SELECT obj_key, size FROM dated")
def _(spark, sf):
    # what was listed before is dropped by the stream's state, which is read again by the second run
    return _listed_twice(spark, sf, remember="7 days")


def _listed_twice(spark, sf, **options):
    db, folder = scratch_database(spark), archive_folder(spark)
    m = crawl_manifest(spark, sf).withColumn("crawl_prefix", M.crawl_prefix("obj_key"))
    for batch in (m.where("seen"), m):  # what was listed before comes again in new files
        batch.select(*MANIFEST_COLUMNS).write.mode("append").parquet(folder)
        ingest.ingest_manifest(spark, folder, f"{db}.crawls", f"{folder}-progress", **options).awaitTermination()
    return spark.read.table(f"{db}.crawls").select("obj_key", "size")


@registry.add(
    "load_gold_unigrams",
    f"""WITH {LABELLED}, {OUTSIDE}, repack AS (SELECT * FROM outside WHERE label = 'repackages')
        SELECT term, count(*) AS frequency FROM ({ngram_sql("repack", "text_norm", 1, STOP_WEB)}) GROUP BY term
        ORDER BY frequency DESC, term LIMIT 100""",
)
def _(spark, sf):
    db = scratch_database(spark)
    tables.overwrite(signals.label_pages(corpus(spark, sf)), f"{db}.gold")
    gold.save_unigrams(spark, f"{db}.gold", f"{db}.unigrams")
    return spark.read.table(f"{db}.unigrams").select("term", "frequency")
