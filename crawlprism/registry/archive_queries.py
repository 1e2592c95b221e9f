"""Record parsing, metadata envelopes, numbering and the silver load."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlprism.functions.urls import in_domains
from crawlprism.operators import dictionaries as D
from crawlprism.operators import numbering
from crawlprism.plans import silver
from crawlprism.registry.base import registry
from crawlprism.registry.fixtures import CORPUS_SQL, PAGE_URLS_SQL, archive_folder, corpus, envelope_lines, load, record_texts
from crawlprism.registry.language_queries import language_sql
from crawlprism.schemas import RECORD_COLUMNS
from crawlprism.sources import gzip_members, wat, wet

PLACED_SQL = f"""{PAGE_URLS_SQL}, placed AS (
  SELECT d.doc_id, d.lang, d.text, p.url FROM documents d
  JOIN page_urls p ON p.page_id = d.doc_id % (SELECT count(*) FROM pages))"""

# characters removed by Python's str.strip, as a SQL expression
_SPACES = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||' '||chr(133)||chr(160)"
_UNIX = "replace(replace({0}, chr(13)||chr(10), chr(10)), chr(13), chr(10))"


def _body(c: str) -> str:
    return f"trim({_UNIX.format(c)}, {_SPACES})"


WET_PARSE_SQL = f"""WITH {PLACED_SQL} SELECT 'conversion' AS rec_type, url AS target_uri,
        '2024-01-01T00:00:00Z' AS warc_date, '<urn:uuid:' || doc_id || '>' AS record_id,
        CAST(NULL AS VARCHAR) AS refers_to, CAST(NULL AS VARCHAR) AS warc_filename,
        CAST(NULL AS VARCHAR) AS is_part_of, CAST(NULL AS VARCHAR) AS block_digest,
        lang AS content_language, 'text/plain' AS content_type,
        CAST(octet_length(encode(text)) AS VARCHAR) AS content_length, {_body("text")} AS content FROM placed"""


@registry.add("wet_parse", WET_PARSE_SQL)
def _(spark, sf):
    return wet.parse_records(record_texts(spark, sf)).select(*RECORD_COLUMNS)


@registry.add("wet_gzip_files", WET_PARSE_SQL)
def _(spark, sf):
    files = gzip_members.write_archives(record_texts(spark, sf), archive_folder(spark))
    return wet.parse_records(gzip_members.gzip_record_scan(files, range_bytes=1024 * 1024)).select(*RECORD_COLUMNS)


@registry.add("wet_plain_files", WET_PARSE_SQL)
def _(spark, sf):
    files = gzip_members.write_archives(record_texts(spark, sf), archive_folder(spark), compressed=False)
    # one file for each writing task; files of repeated tasks are not listed
    return wet.wet_records(spark, [r["path"] for r in files.collect()]).select(*RECORD_COLUMNS)


@registry.add(
    "wet_headers",
    f"""WITH {PLACED_SQL} SELECT doc_id, 'conversion' AS rec_type, url AS target_uri, lang AS content_language,
          CAST(NULL AS VARCHAR) AS warc_filename, 'text/plain' AS content_type FROM placed
        UNION ALL SELECT -page_id - 1, 'warcinfo', NULL, NULL, 'f' || page_id || '.warc.wet.gz',
          'application/warc-fields' FROM pages""",
)
def _(spark, sf):
    every = wet.parse_records(record_texts(spark, sf), keep=["doc_id"], drop_type=None)
    return every.select("doc_id", "rec_type", "target_uri", "content_language", "warc_filename", "content_type")


@registry.add(
    "wet_drop_warcinfo",
    f"WITH {PLACED_SQL} SELECT 'conversion' AS rec_type, count(*) AS n FROM placed",
)
def _(spark, sf):
    return wet.parse_records(record_texts(spark, sf)).groupBy("rec_type").agg(F.count(F.lit(1)).alias("n"))


@registry.add(
    "content_length_filter",
    f"""WITH {PLACED_SQL} SELECT '<urn:uuid:' || doc_id || '>' AS record_id,
        CAST(octet_length(encode(text)) AS INT) AS content_length FROM placed WHERE octet_length(encode(text)) > 30""",
)
def _(spark, sf):
    return wet.longer_than(wet.parse_records(record_texts(spark, sf))).select(
        "record_id", F.col("content_length").try_cast("int").alias("content_length")
    )


# --- metadata envelopes ----------------------------------------------------------------

_ENVELOPE_SQL = """'{"Container":{"Filename":"f' || page_id || '.warc.gz","Compressed":true,"Offset":"' || page_id
  || '","Gzip-Metadata":{"Deflate-Length":"100","Header-Length":"10","Footer-Length":"8","Inflated-CRC":"7",'
  || '"Inflated-Length":"' || length(html) || '"}},"Envelope":{"Payload-Metadata":{"Actual-Content-Length":"'
  || length(html) || '","Trailing-Slop-Length":"0","Block-Digest":"' || md5(html)
  || '","Headers-Corrupt":false,"Actual-Content-Type":"text/html","WARC-Info-Metadata":'
  || '{"isPartOf":"CC-MAIN-2024-10","publisher":"p","description":"d","operator":"o","hostname":"h",'
  || '"software":"s","robots":"r","format":"WARC"}},"Format":"WARC","WARC-Header-Length":"300",'
  || '"WARC-Header-Metadata":{"WARC-Type":"response","WARC-Date":"2024-01-01T00:00:00Z","WARC-Record-ID":'
  || '"<urn:uuid:' || page_id || '>","Content-Length":"' || length(html) || '","Content-Type":"application/http"}}}'"""


@registry.add(
    "wat_lines",
    f"""SELECT {_ENVELOPE_SQL} AS value FROM pages
        UNION ALL SELECT '{{bad ' || page_id || '}}' FROM pages""",
)
def _(spark, sf):
    return wat.json_lines(envelope_lines(spark, sf))


_FLAT_SQL = {
    "Container_Filename": "'f' || page_id || '.warc.gz'",
    "Container_Compressed": "true",
    "Container_Offset": "CAST(page_id AS VARCHAR)",
    "Container_Gzip_Metadata_Deflate_Length": "'100'",
    "Container_Gzip_Metadata_Header_Length": "'10'",
    "Container_Gzip_Metadata_Footer_Length": "'8'",
    "Container_Gzip_Metadata_Inflated_CRC": "'7'",
    "Container_Gzip_Metadata_Inflated_Length": "CAST(length(html) AS VARCHAR)",
    "Envelope_Payload_Metadata_Actual_Content_Length": "CAST(length(html) AS VARCHAR)",
    "Envelope_Payload_Metadata_Trailing_Slop_Length": "'0'",
    "Envelope_Payload_Metadata_Block_Digest": "md5(html)",
    "Envelope_Payload_Metadata_Headers_Corrupt": "false",
    "Envelope_Payload_Metadata_Actual_Content_Type": "'text/html'",
    "Envelope_Payload_Metadata_WARC_Info_Metadata_isPartOf": "'CC-MAIN-2024-10'",
    "Envelope_Payload_Metadata_WARC_Info_Metadata_publisher": "'p'",
    "Envelope_Payload_Metadata_WARC_Info_Metadata_description": "'d'",
    "Envelope_Payload_Metadata_WARC_Info_Metadata_operator": "'o'",
    "Envelope_Payload_Metadata_WARC_Info_Metadata_hostname": "'h'",
    "Envelope_Payload_Metadata_WARC_Info_Metadata_software": "'s'",
    "Envelope_Payload_Metadata_WARC_Info_Metadata_robots": "'r'",
    "Envelope_Payload_Metadata_WARC_Info_Metadata_format": "'WARC'",
    "Envelope_Format": "'WARC'",
    "Envelope_WARC_Header_Length": "'300'",
    "Envelope_WARC_Header_Metadata_WARC_Type": "'response'",
    "Envelope_WARC_Header_Metadata_WARC_Date": "'2024-01-01T00:00:00Z'",
    "Envelope_WARC_Header_Metadata_WARC_Record_ID": "'<urn:uuid:' || page_id || '>'",
    "Envelope_WARC_Header_Metadata_Content_Length": "CAST(length(html) AS VARCHAR)",
    "Envelope_WARC_Header_Metadata_Content_Type": "'application/http'",
    "Envelope_WARC_Header_Metadata_WARC_Filename": "CAST(NULL AS VARCHAR)",
}


@registry.add(
    "wat_flatten",
    "SELECT "
    + ", ".join(f"{expr} AS {name}" for name, expr in _FLAT_SQL.items())
    + " FROM pages UNION ALL SELECT "
    + ", ".join("NULL" for _ in _FLAT_SQL)
    + " FROM pages",
)
def _(spark, sf):
    return wat.wat_records(envelope_lines(spark, sf))


# --- numbering ---------------------------------------------------------------------------


@registry.add(
    "row_numbers",
    """SELECT record_id, row_num FROM (
         SELECT '<urn:uuid:' || doc_id || '>' AS record_id, n_chars,
                row_number() OVER (ORDER BY '<urn:uuid:' || doc_id || '>') AS row_num FROM documents)
       WHERE n_chars > 30""",
)
def _(spark, sf):
    docs = load(spark, sf, "documents", "doc_id", "n_chars").select(
        F.concat(F.lit("<urn:uuid:"), F.col("doc_id").cast("string"), F.lit(">")).alias("record_id"), "n_chars"
    )
    numbered = numbering.with_row_number(docs, ["record_id"])
    return numbered.where(F.col("n_chars") > 30).select("record_id", "row_num")


LINES_SQL = """lines AS (
  SELECT doc_id // 10 AS file_no, doc_id, unnest(range(len(parts))) AS pos, unnest(parts) AS value
  FROM (SELECT doc_id, list_concat(['WARC/1.0'], string_split(text, chr(10))) AS parts FROM documents)),
numbered AS (
  SELECT *, sum(CASE WHEN value = 'WARC/1.0' THEN 1 ELSE 0 END)
            OVER (PARTITION BY file_no ORDER BY doc_id, pos ROWS UNBOUNDED PRECEDING) AS record_no FROM lines)"""


def _lines(spark, sf):
    parts = F.concat(F.array(F.lit("WARC/1.0")), F.split("text", "\n"))
    file_no = F.floor(F.col("doc_id") / 10).alias("file_no")
    return load(spark, sf, "documents", "doc_id", "text").select(file_no, "doc_id", F.posexplode(parts).alias("pos", "value"))


@registry.add(
    "running_record_id",
    f"""WITH {LINES_SQL} SELECT file_no, doc_id, CAST(pos AS INT) AS pos, md5(value) AS line,
        CAST(record_no AS BIGINT) AS record_no FROM numbered""",
)
def _(spark, sf):
    numbered = numbering.number_records(_lines(spark, sf), ["doc_id", "pos"], file_col="file_no")
    return numbered.select("file_no", "doc_id", "pos", F.md5("value").alias("line"), "record_no")


@registry.add(
    "running_record_id_of_all",
    f"""WITH {LINES_SQL} SELECT doc_id, CAST(pos AS INT) AS pos,
        CAST(sum(CASE WHEN value = 'WARC/1.0' THEN 1 ELSE 0 END) OVER (ORDER BY doc_id, pos ROWS UNBOUNDED PRECEDING) AS BIGINT) AS record_no
        FROM lines""",
)
def _(spark, sf):
    return numbering.number_records(_lines(spark, sf), ["doc_id", "pos"]).select("doc_id", "pos", "record_no")


@registry.add(
    "joined_lines",
    f"""WITH {LINES_SQL} SELECT file_no, CAST(record_no AS BIGINT) AS record_no,
        md5(string_agg(value, chr(10) ORDER BY doc_id, pos)) AS record_text FROM numbered GROUP BY file_no, record_no""",
)
def _(spark, sf):
    numbered = numbering.number_records(_lines(spark, sf), ["doc_id", "pos"], file_col="file_no")
    records = numbering.join_lines(numbered, ["doc_id", "pos"], file_col="file_no")
    return records.select("file_no", "record_no", F.md5("record_text").alias("record_text"))


# --- silver load --------------------------------------------------------------------------

_KEYWORDS = "|".join(D.PRODUCT_KEYWORDS)
_SILVER_SQL = rf"""{CORPUS_SQL}, body AS (
  SELECT record_id, target_uri, {_body("content")} AS content, octet_length(encode(content)) AS content_length,
         row_number() OVER (ORDER BY record_id) AS row_num FROM corpus),
flagged AS (
  SELECT *, content_length > 30 AS kept,
         content_length > 30 AND regexp_matches(target_uri, '://[^/]*\.(com|org|edu|gov)(/|$)')
         AND regexp_matches(lower(content), '{_KEYWORDS}') AS found FROM body)"""


@registry.add(
    "silver_pages",
    f"""WITH {_SILVER_SQL}, {language_sql("flagged", "record_id", "content")}
        SELECT record_id, target_uri, CAST(content_length AS VARCHAR) AS content_length, md5(content) AS content,
               lang_status, row_num FROM flagged JOIN lang_status USING (record_id) WHERE found""",
)
def _(spark, sf):
    pages, _ = silver.silver_pages(wet.parse_all(record_texts(spark, sf, with_signals=True)))
    return pages.select(
        "record_id", "target_uri", "content_length", F.md5("content").alias("content"), "lang_status", "row_num"
    )


@registry.add(
    "run_summary",
    f"""WITH {_SILVER_SQL}, {language_sql("flagged", "record_id", "content")}
        SELECT count(*) FILTER (WHERE found AND lang_status = 'english_only') AS total_products_found,
               count(*) AS total_clean_count,
               count(*) FILTER (WHERE kept) AS total_english_records_found,
               count(*) + (SELECT count(*) FROM pages) AS total_records_processed,
               count(*) FILTER (WHERE kept AND lang_status = 'english_only') AS total_english_only
        FROM flagged JOIN lang_status USING (record_id)""",
)
def _(spark, sf):
    records = wet.parse_all(record_texts(spark, sf, with_signals=True))
    _, summary = silver.silver_pages(records, english_only=True)
    return summary


@registry.add(
    "domain_filter",
    rf"""WITH {CORPUS_SQL} SELECT record_id, target_uri FROM corpus
        WHERE regexp_matches(target_uri, '://[^/]*\.(com|org|edu|gov)(/|$)')""",
)
def _(spark, sf):
    return corpus(spark, sf).where(in_domains("target_uri")).select("record_id", "target_uri")
