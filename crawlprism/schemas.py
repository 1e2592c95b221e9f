"""Declared schemas and the naming used across tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

# canonical column -> header-style name of the archive format
RECORD_COLUMNS = {
    "rec_type": "Type",
    "target_uri": "Target-URI",
    "warc_date": "Date",
    "record_id": "Record-ID",
    "refers_to": "Refers-To",
    "warc_filename": "WARC-Filename",
    "is_part_of": "isPartOf",
    "block_digest": "Block-Digest",
    "content_language": "Identified-Content-Language",
    "content_type": "Content-Type",
    "content_length": "Content-Length",
    "content": "Content",
}

MANIFEST_COLUMNS = {
    "obj_key": "Key",
    "last_modified": "LastModified",
    "etag": "ETag",
    "size": "Size",
    "storage_class": "StorageClass",
    "checksum_algorithm": "ChecksumAlgorithm",
    "crawl_prefix": "crawl_prefix",
}

RECORD_SCHEMA = ", ".join(f"{name} string" for name in RECORD_COLUMNS)

MANIFEST_SCHEMA = (
    "obj_key string, last_modified timestamp, etag string, size bigint, "
    "storage_class string, checksum_algorithm array<string>, crawl_prefix string"
)

# Field names and types of a metadata-archive envelope.
WAT_SCHEMA = (
    "Container struct<Filename: string, Compressed: boolean, Offset: string, "
    "`Gzip-Metadata`: struct<`Deflate-Length`: string, `Header-Length`: string, "
    "`Footer-Length`: string, `Inflated-CRC`: string, `Inflated-Length`: string>>, "
    "Envelope struct<"
    "`Payload-Metadata`: struct<`Actual-Content-Length`: string, `Trailing-Slop-Length`: string, "
    "`Block-Digest`: string, `Headers-Corrupt`: boolean, `Actual-Content-Type`: string, "
    "`WARC-Info-Metadata`: struct<isPartOf: string, publisher: string, description: string, "
    "operator: string, hostname: string, software: string, robots: string, format: string>>, "
    "Format: string, `WARC-Header-Length`: string, "
    "`WARC-Header-Metadata`: struct<`WARC-Type`: string, `WARC-Date`: string, "
    "`WARC-Record-ID`: string, `Content-Length`: string, `Content-Type`: string, "
    "`WARC-Filename`: string>>"
)


def to_header_names(df: DataFrame, names: dict[str, str] = RECORD_COLUMNS) -> DataFrame:
    """Rename canonical columns back to the header-style names, leaving other columns alone."""
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def to_canonical_names(df: DataFrame, names: dict[str, str] = RECORD_COLUMNS) -> DataFrame:
    return df.withColumnsRenamed({v: k for k, v in names.items() if v in df.columns})
