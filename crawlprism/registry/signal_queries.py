"""Keywords, regex signals, labels and the reports over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlprism.functions import text as X
from crawlprism.operators import dictionaries as D
from crawlprism.operators import features, reports, signals
from crawlprism.registry.base import registry
from crawlprism.registry.fixtures import (
    CORPUS_SQL,
    NORM,
    PAGE_URLS_SQL,
    PHRASED_SQL,
    SALTED_SQL,
    corpus,
    labelled_sql,
    page_urls,
    phrased,
    salted,
    sql_list,
)

SALTED_LABELS = f"WITH {SALTED_SQL}, {labelled_sql('salted', 'doc_id')}"
CORPUS_LABELS = f"WITH {CORPUS_SQL}, {labelled_sql('corpus', 'record_id, target_uri')}"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --- keywords -------------------------------------------------------------------------------


def _keyword_query(name: str, words: list[str], fixture, fixture_sql: str, relation: str) -> None:
    pattern = _quoted("|".join(words))

    @registry.add(
        f"keyword_{name}",
        f"WITH {fixture_sql} SELECT doc_id FROM {relation} WHERE regexp_matches(lower(content), {pattern})",
    )
    def _(spark, sf):
        return signals.filter_by_keywords(fixture(spark, sf), words).select("doc_id")


_keyword_query("product", D.PRODUCT_KEYWORDS, salted, SALTED_SQL, "salted")
_keyword_query("geographic", D.GEOGRAPHIC_KEYWORDS, phrased, PHRASED_SQL, "phrased")
_keyword_query("subject", D.SUBJECT_KEYWORDS, phrased, PHRASED_SQL, "phrased")


@registry.add(
    "keyword_hits",
    f"WITH {PHRASED_SQL}, words AS ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS list_name, unnest({sql_list(words)}) AS keyword"
        for name, words in D.KEYWORD_LISTS.items()
    )
    + """) SELECT list_name, keyword, count(*) FILTER (WHERE regexp_matches(lower(content), keyword)) AS pages
         FROM words, phrased GROUP BY ALL""",
)
def _(spark, sf):
    return signals.keyword_counts(phrased(spark, sf))


@registry.add(
    "subject_keyword_rows",
    f"""WITH {PHRASED_SQL}, words AS (SELECT unnest({sql_list(D.SUBJECT_KEYWORDS)}) AS keyword)
        SELECT doc_id, keyword FROM words, phrased WHERE regexp_matches(lower(content), keyword)""",
)
def _(spark, sf):
    lists = {"subject": D.SUBJECT_KEYWORDS}
    return signals.keyword_hits(phrased(spark, sf), ["doc_id"], lists=lists).select("doc_id", "keyword")


# --- regex signals ----------------------------------------------------------------------------


def _signal_sql(name: str, pattern: str, text: str) -> str:
    """The pattern in a dialect without lookahead."""
    if name == "census_generic":
        return (
            rf"regexp_matches(regexp_replace({text}, '\bcensus\s*of\s*agriculture', '#', 'g'), '\bcensus\b')"
        )
    return f"regexp_matches({text}, {_quoted(pattern.replace('(?!' + chr(92) + 'w)', ''))})"


@registry.add(
    "signal_counts",
    f"WITH {PHRASED_SQL}, norm AS (SELECT doc_id, {NORM} AS text_norm FROM phrased) "
    + " UNION ALL ".join(
        f"SELECT '{n}' AS signal, count(*) FILTER (WHERE {_signal_sql(n, p, 'text_norm')}) AS pages "
        "FROM norm WHERE length(text_norm) > 100"
        for n, p in D.CENSUS_SIGNALS.items()
    ),
)
def _(spark, sf):
    flagged = signals.with_signals(signals.long_enough(phrased(spark, sf)))
    counts = flagged.agg(*[F.count_if(n).alias(n) for n in D.CENSUS_SIGNALS])
    return counts.unpivot([], list(D.CENSUS_SIGNALS), "signal", "pages")


@registry.add(
    "acs_pattern_counts",
    f"WITH {PHRASED_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{n}' AS signal, count(*) FILTER (WHERE {_signal_sql(n, p, 'content')}) AS pages FROM phrased"
        for n, p in D.ACS_SIGNALS.items()
    ),
)
def _(spark, sf):
    flagged = signals.with_acs_signals(phrased(spark, sf))
    counts = flagged.agg(*[F.count_if(n).alias(n) for n in D.ACS_SIGNALS])
    return counts.unpivot([], list(D.ACS_SIGNALS), "signal", "pages")


@registry.add(
    "acs_table_ids",
    f"""WITH {PHRASED_SQL}, words AS (
          SELECT DISTINCT doc_id, unnest(regexp_extract_all(upper(content), '[0-9A-Z_]+')) AS table_id FROM phrased)
        SELECT doc_id, table_id FROM words WHERE list_contains({sql_list(D.ACS_TABLE_IDS)}, table_id)""",
)
def _(spark, sf):
    ids = signals.table_ids(F.col("content"))
    return phrased(spark, sf).select("doc_id", F.explode(ids).alias("table_id"))


@registry.add(
    "acs_product_names",
    f"""WITH {PHRASED_SQL}, names AS (SELECT unnest({sql_list(D.ACS_PRODUCT_NAMES)}) AS product)
        SELECT doc_id, product FROM phrased, names WHERE contains(content, product)""",
)
def _(spark, sf):
    names = signals.product_names(F.col("content"))
    return phrased(spark, sf).select("doc_id", F.explode(names).alias("product"))


@registry.add(
    "any_census_flag",
    f"""WITH {PHRASED_SQL}, norm AS (SELECT doc_id, {NORM} AS text_norm FROM phrased)
        SELECT doc_id, """
    + " OR ".join(_signal_sql(n, p, "text_norm") for n, p in D.CENSUS_SIGNALS.items())
    + " AS has_any_census FROM norm WHERE length(text_norm) > 100",
)
def _(spark, sf):
    return signals.enrich(phrased(spark, sf)).select("doc_id", "has_any_census")


@registry.add(
    "attribution_flags",
    f"""{SALTED_LABELS} SELECT doc_id, credited AS has_explicit_attrib, linked AS has_census_domain,
          num_density > 0.12 AND NOT credited AND NOT linked AS repackage_heuristic,
          round(num_density, 6) AS num_density FROM scored""",
)
def _(spark, sf):
    return signals.enrich(salted(spark, sf)).select(
        "doc_id",
        "has_explicit_attrib",
        "has_census_domain",
        "repackage_heuristic",
        F.round("num_density", 6).alias("num_density"),
    )


@registry.add(
    "label_counts",
    f"{SALTED_LABELS} SELECT label, count(*) AS n FROM labelled WHERE label IS NOT NULL GROUP BY label",
)
def _(spark, sf):
    return features.label_counts(signals.label_pages(salted(spark, sf)))


@registry.add(
    "labelled_pages",
    f"""{CORPUS_LABELS} SELECT record_id, target_uri, label, md5(text_norm) AS text_norm
        FROM labelled WHERE label IS NOT NULL""",
)
def _(spark, sf):
    return signals.label_pages(corpus(spark, sf)).select(
        "record_id", "target_uri", "label", F.md5("text_norm").alias("text_norm")
    )


# --- domain and site reports ----------------------------------------------------------------------

_HOST = r"replace(regexp_extract({0}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1), 'www.', '')"


@registry.add(
    "site_columns",
    rf"""WITH {PAGE_URLS_SQL} SELECT page_id, {_HOST.format('url')} AS root_url,
          nullif(regexp_extract({_HOST.format('url')}, '\.[a-zA-Z]{{2,}}$'), '') AS tld FROM page_urls""",
)
def _(spark, sf):
    pages = page_urls(spark, sf)
    return reports.with_site_columns(pages, "url").drop("url")


@registry.add(
    "root_url_counts",
    f"""{CORPUS_LABELS} SELECT {_HOST.format('target_uri')} AS root_url, count(*) AS n FROM labelled
        WHERE label = 'repackages' GROUP BY 1 ORDER BY n DESC, root_url LIMIT 10""",
)
def _(spark, sf):
    pages = signals.label_pages(corpus(spark, sf)).where(F.col("label") == "repackages")
    return reports.counts_by(reports.with_site_columns(pages), "root_url", 10)


@registry.add(
    "tld_counts",
    rf"""{CORPUS_LABELS} SELECT tld, count(*) AS n FROM (
          SELECT nullif(regexp_extract({_HOST.format('target_uri')}, '\.[a-zA-Z]{{2,}}$'), '') AS tld
          FROM labelled WHERE label = 'repackages') WHERE tld IS NOT NULL GROUP BY 1""",
)
def _(spark, sf):
    pages = signals.label_pages(corpus(spark, sf)).where(F.col("label") == "repackages")
    return reports.counts_by(reports.with_site_columns(pages), "tld")


_SITES = ["example.org", "blog.", *D.SITES_OF_INTEREST]


@registry.add(
    "site_presence",
    f"""{CORPUS_LABELS}, sites AS (SELECT unnest({sql_list(_SITES)}) AS site)
        SELECT site, count(record_id) > 0 AS present, count(*) FILTER (WHERE label = 'cites') AS cites,
               count(*) FILTER (WHERE label = 'repackages') AS repackages
        FROM sites LEFT JOIN (SELECT * FROM labelled WHERE label IS NOT NULL) l
          ON regexp_matches(l.target_uri, site) GROUP BY site""",
)
def _(spark, sf):
    return reports.site_presence(signals.label_pages(corpus(spark, sf)), _SITES)


@registry.add(
    "site_drilldown",
    f"""{CORPUS_LABELS} SELECT record_id, target_uri, label FROM labelled
        WHERE label IS NOT NULL AND regexp_matches(target_uri, 'blog.th')""",
)
def _(spark, sf):
    labelled = signals.label_pages(corpus(spark, sf))
    return reports.site_rows(labelled, "blog.th").select("record_id", "target_uri", "label")


@registry.add(
    "exclude_site",
    f"""{CORPUS_LABELS} SELECT record_id, {_HOST.format('target_uri')} AS root_url FROM labelled
        WHERE label IS NOT NULL AND {_HOST.format('target_uri')} <> 'census.gov'""",
)
def _(spark, sf):
    pages = reports.with_site_columns(signals.label_pages(corpus(spark, sf)))
    return pages.where(F.col("root_url") != "census.gov").select("record_id", "root_url")


@registry.add(
    "stripped_text_lengths",
    f"WITH {SALTED_SQL} SELECT doc_id, length({NORM}) AS n FROM salted",
)
def _(spark, sf):
    norm = F.length(X.normalize_text("content")).cast("bigint")
    return salted(spark, sf).select("doc_id", norm.alias("n"))
