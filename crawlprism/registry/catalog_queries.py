"""Object catalog, sampling and delta queries over the crawl manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlprism.operators import joins, sampling
from crawlprism.registry.base import registry
from crawlprism.registry.fixtures import MANIFEST_SQL, crawl_manifest
from crawlprism.sources import manifest as M

WITH = f"WITH {MANIFEST_SQL}"
STAMP = "%Y-%m-%d %H:%M:%S"


def _text(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


def _seen(m: DataFrame) -> DataFrame:
    return m.where("seen").select("obj_key")


@registry.add("master_indexes", f"{WITH} SELECT DISTINCT crawl_prefix AS master_index FROM dated")
def _(spark, sf):
    return M.master_indexes(crawl_manifest(spark, sf))


@registry.add(
    "master_indexes_of_year",
    f"{WITH} SELECT DISTINCT crawl_prefix AS master_index FROM dated WHERE contains(crawl_prefix, '1997')",
)
def _(spark, sf):
    return M.master_indexes(crawl_manifest(spark, sf)).where(F.col("master_index").contains("1997"))


@registry.add(
    "crawls_by_year",
    f"""{WITH} SELECT CAST(year(crawl_start) AS INT) AS crawl_year, count(*) AS n FROM dated
        WHERE contains(obj_key, 'wet') AND crawl_start IS NOT NULL GROUP BY 1""",
)
def _(spark, sf):
    dated = M.dated_crawls(crawl_manifest(spark, sf))
    return dated.groupBy(F.year("crawl_start").alias("crawl_year")).agg(F.count(F.lit(1)).alias("n"))


@registry.add(
    "crawls_of_one_year",
    f"""{WITH} SELECT obj_key, strftime(crawl_start, '{STAMP}') AS crawl_start FROM dated
        WHERE contains(obj_key, 'wet') AND year(crawl_start) = 1996""",
)
def _(spark, sf):
    return M.of_year(M.dated_crawls(crawl_manifest(spark, sf)), "1996").select("obj_key", _text("crawl_start"))


@registry.add(
    "crawl_times",
    f"""{WITH} SELECT obj_key, strftime(crawl_start, '{STAMP}') AS crawl_start,
        strftime(crawl_end, '{STAMP}') AS crawl_end FROM dated""",
)
def _(spark, sf):
    return M.with_crawl_times(crawl_manifest(spark, sf)).select("obj_key", _text("crawl_start"), _text("crawl_end"))


@registry.add(
    "crawl_anti_join",
    f"""{WITH} SELECT obj_key, strftime(crawl_start, '{STAMP}') AS crawl_start FROM dated d
        WHERE contains(obj_key, 'wet') AND crawl_start IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM manifest s WHERE s.seen AND s.obj_key = d.obj_key)""",
)
def _(spark, sf):
    m = crawl_manifest(spark, sf)
    return joins.exclude_seen(M.dated_crawls(m), _seen(m)).select("obj_key", _text("crawl_start"))


@registry.add(
    "crawl_sample_per_year",
    f"""{WITH}, ranked AS (
        SELECT obj_key, crawl_start,
               row_number() OVER (PARTITION BY year(crawl_start) ORDER BY crawl_start, obj_key) AS rn
        FROM dated WHERE contains(obj_key, 'wet') AND crawl_start IS NOT NULL AND NOT seen)
        SELECT obj_key, strftime(crawl_start, '{STAMP}') AS crawl_start FROM ranked
        WHERE rn <= 2 AND year(crawl_start) BETWEEN 1995 AND 1998""",
)
def _(spark, sf):
    m = crawl_manifest(spark, sf)
    fresh = joins.exclude_seen(M.dated_crawls(m), _seen(m))
    years = ["1995", "1996", "1997", "1998"]
    return sampling.sample_crawls(fresh, years, limit=2).select("obj_key", _text("crawl_start"))


@registry.add(
    "crawl_random_pick",
    f"""{WITH}, ranked AS (
        SELECT obj_key, row_number() OVER (PARTITION BY year(last_modified) ORDER BY md5(obj_key), obj_key) AS rn
        FROM dated WHERE contains(obj_key, 'warc.gz'))
        SELECT obj_key FROM ranked WHERE rn = 1""",
)
def _(spark, sf):
    return sampling.pick_per_year(crawl_manifest(spark, sf), "warc.gz").select("obj_key")


LATEST_SQL = f"""{WITH}, recent AS (
    SELECT * FROM dated WHERE starts_with(obj_key, (SELECT max(crawl_prefix) FROM dated)))"""


def _recent(m: DataFrame) -> DataFrame:
    newest = M.master_indexes(m).agg(F.max("master_index")).scalar()
    return m.withColumn("crawl_prefix", newest).where(F.startswith("obj_key", F.col("crawl_prefix")))


@registry.add(
    "crawl_delta",
    f"""{LATEST_SQL} SELECT obj_key, size, crawl_prefix FROM recent r
        WHERE NOT EXISTS (SELECT 1 FROM manifest s WHERE s.seen AND s.obj_key = r.obj_key)""",
)
def _(spark, sf):
    m = crawl_manifest(spark, sf)
    return joins.new_rows(_recent(m), _seen(m), "obj_key", ["obj_key", "size", "crawl_prefix"])


@registry.add(
    "crawl_union",
    f"""{LATEST_SQL} SELECT obj_key, size FROM manifest WHERE seen
        UNION ALL
        SELECT obj_key, size FROM recent r
        WHERE NOT EXISTS (SELECT 1 FROM manifest s WHERE s.seen AND s.obj_key = r.obj_key)""",
)
def _(spark, sf):
    m = crawl_manifest(spark, sf)
    bronze = m.where("seen").select("obj_key", "size")
    return joins.union_all([bronze, joins.new_rows(_recent(m), bronze, "obj_key", ["size", "obj_key"])])


@registry.add(
    "crawl_union_missing_cols",
    f"""{WITH} SELECT obj_key, size, strftime(crawl_start, '{STAMP}') AS crawl_start FROM dated
        WHERE contains(obj_key, 'wet')
        UNION ALL SELECT obj_key, size, NULL FROM dated WHERE NOT contains(obj_key, 'wet')""",
)
def _(spark, sf):
    m = crawl_manifest(spark, sf).select("obj_key", "size")
    wet = M.with_crawl_times(m.where(F.col("obj_key").contains("wet"))).select(
        "obj_key", "size", _text("crawl_start")
    )
    return joins.union_all([wet, m.where(~F.col("obj_key").contains("wet"))])


@registry.add(
    "crawl_listing",
    f"""{WITH} SELECT obj_key, size, crawl_prefix FROM dated WHERE contains(crawl_prefix, 'MAIN-1997')""",
)
def _(spark, sf):
    m = crawl_manifest(spark, sf)
    wanted = M.master_indexes(m).where(F.col("master_index").contains("MAIN-1997"))
    return M.ingest_crawls(m, wanted).select("obj_key", "size", "crawl_prefix")


@registry.add(
    "crawl_listing_deep",
    f"""{WITH}, wanted AS (
          SELECT DISTINCT crawl_prefix AS p FROM dated WHERE contains(crawl_prefix, 'MAIN-1997-0')
          UNION SELECT DISTINCT regexp_extract(obj_key, '^([^/]+/[^/]+/[^/]+/[^/]+/)', 1) FROM dated
          WHERE contains(obj_key, '/segments/1'))
        SELECT obj_key, size, p AS crawl_prefix FROM dated JOIN wanted ON starts_with(obj_key, p)""",
)
def _(spark, sf):
    m = crawl_manifest(spark, sf)
    crawls = M.master_indexes(m).where(F.col("master_index").contains("MAIN-1997-0"))
    segments = m.where(F.col("obj_key").contains("/segments/1")).select(
        F.concat(F.substring_index("obj_key", "/", 4), F.lit("  ")).alias("master_index")
    )
    return M.ingest_crawls(m, crawls.unionAll(segments)).select("obj_key", "size", "crawl_prefix")


@registry.add(
    "crawl_listing_json",
    f"""{WITH} SELECT '{{"obj_key":"' || obj_key || '","size":' || size || '}}' AS json FROM dated
        WHERE starts_with(obj_key, 'crawl-data/CC-MAIN-1996-03/')""",
)
def _(spark, sf):
    one = M.list_crawls(crawl_manifest(spark, sf), "crawl-data/CC-MAIN-1996-03")
    return M.as_json(one.select("obj_key", "size"))


@registry.add("latest_crawl", f"{WITH} SELECT max(crawl_prefix) AS master_index FROM dated")
def _(spark, sf):
    return M.master_indexes(crawl_manifest(spark, sf)).agg(F.max("master_index").alias("master_index"))


@registry.add(
    "prefix_list",
    r"""SELECT rtrim(regexp_extract('  crawl-data/CC-MAIN-' || strftime(o_orderdate, '%Y-%m'), 'crawl.*'), '/') || '/'
               AS prefix, min(o_orderkey) AS first_seen FROM orders GROUP BY 1""",
)
def _(spark, sf):
    # prefixes as a table would hold them: padded, and only some with a trailing slash
    m = crawl_manifest(spark, sf)
    slash = F.when(F.col("seen"), "/").otherwise("  ")
    raw = F.concat(F.lit("  "), F.rtrim(M.crawl_prefix("obj_key"), F.lit("/")), slash)
    return M.prefix_list(m.select(raw.alias("master_index"), "o_orderkey"), "master_index", "o_orderkey")


@registry.add("basename", f"{WITH} SELECT obj_key, regexp_extract(obj_key, '[^/]*$') AS file_name FROM dated")
def _(spark, sf):
    return crawl_manifest(spark, sf).select("obj_key", M.basename("obj_key").alias("file_name"))


@registry.add(
    "duplicate_objects",
    f"""{WITH} SELECT count(*) AS duplicate_keys FROM (
        SELECT obj_key FROM (SELECT obj_key FROM dated UNION ALL SELECT obj_key FROM dated WHERE seen)
        GROUP BY 1 HAVING count(*) > 1)""",
)
def _(spark, sf):
    # a listing that was appended once more for the objects already seen
    m = crawl_manifest(spark, sf)
    twice = m.select("obj_key").unionAll(m.where("seen").select("obj_key"))
    return joins.count_duplicate_keys(twice, "obj_key")
