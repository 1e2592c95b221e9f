"""Archive records: files written here are read back; one test per parsing quirk."""

import gzip

import pytest
from pyspark.sql import functions as F

from crawlprism.schemas import RECORD_COLUMNS, to_canonical_names, to_header_names
from crawlprism.sources import wet


def record(headers: list[str], body: str, newline: str = "\r\n") -> str:
    return newline.join(["WARC/1.0", *headers, "", body, "", ""])


def page(i: int, body: str) -> str:
    return record(
        [
            "WARC-Type: conversion",
            f"WARC-Target-URI: https://site{i}.org/a",
            "WARC-Date: 2024-01-01T00:00:00Z",
            f"WARC-Record-ID: <urn:uuid:{i}>",
            "Content-Type: text/plain",
            f"Content-Length: {len(body.encode())}",
        ],
        body,
    )


INFO = record(["WARC-Type: warcinfo", "WARC-Filename: f.gz", "Content-Length: 9"], "isPartOf: x")


@pytest.fixture(scope="module")
def bodies(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] for r in rows}


def expected(body: str) -> str:
    return body.replace("\r\n", "\n").replace("\r", "\n").strip()


def write_plain(path, texts):
    path.write_bytes("".join([INFO, *texts]).encode())


def write_gzip(path, texts):
    path.write_bytes(b"".join(gzip.compress(t.encode()) for t in [INFO, *texts]))


@pytest.mark.parametrize("writer, name", [(write_plain, "a.warc.wet"), (write_gzip, "a.warc.wet.gz")])
def test_round_trip(spark, tmp_path, bodies, writer, name):
    writer(tmp_path / name, [page(i, b) for i, b in bodies.items()])
    got = {r["record_id"]: r for r in wet.wet_records(spark, str(tmp_path / name)).collect()}
    assert len(got) == len(bodies)
    for i, body in bodies.items():
        row = got[f"<urn:uuid:{i}>"]
        assert row["content"] == expected(body)
        assert row["target_uri"] == f"https://site{i}.org/a"
        assert row["content_length"] == str(len(body.encode()))
        assert row["rec_type"] == "conversion" and row["refers_to"] is None


def test_plain_file_is_splittable(spark, tmp_path, bodies):
    path = tmp_path / "big.warc.wet"
    write_plain(path, [page(i, b) for i, b in bodies.items()])
    size = str(max(1, path.stat().st_size // 7))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        scan = wet.record_scan(spark, str(path))
        assert scan.rdd.getNumPartitions() > 3
        assert wet.parse_records(scan).select("record_id").distinct().count() == len(bodies)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def parse(spark, text: str, **kwargs):
    rows = wet.parse_records(spark.createDataFrame([(text,)], "value string"), drop_type=None, **kwargs).collect()
    return rows[0] if rows else None


def test_lf_only_files(spark, tmp_path):
    path = tmp_path / "lf.wet"
    path.write_bytes(page(1, "one").replace("\r\n", "\n").encode() + page(2, "two").replace("\r\n", "\n").encode())
    assert wet.wet_records(spark, str(path), newline="\n").count() == 2


def test_marker_inside_a_page_does_not_split(spark, tmp_path):
    path = tmp_path / "m.wet"
    path.write_bytes((page(1, "see WARC/1.0\nWARC/1.0\nend") + page(2, "two")).encode())
    rows = {r["record_id"]: r["content"] for r in wet.wet_records(spark, str(path)).collect()}
    assert rows == {"<urn:uuid:1>": "see WARC/1.0\nWARC/1.0\nend", "<urn:uuid:2>": "two"}


def test_no_content_length_is_dropped(spark):
    assert parse(spark, "WARC-Type: conversion\r\n\r\nbody") is None


def test_content_length_must_be_last(spark):
    assert parse(spark, "Content-Length: 4\r\nWARC-Type: conversion\r\n\r\nbody") is None


def test_irregular_record_is_cut_at_the_first_length_line_before_a_blank(spark):
    row = parse(spark, "Content-Length: 4\nWARC-Type: a\n\nbody\nContent-Length: 9\n\nrest")
    assert (row["rec_type"], row["content_length"], row["content"]) == ("a", "4", "rest")


def test_length_comes_from_its_first_occurrence(spark):
    row = parse(spark, "Content-Length: 4\nWARC-Type: a\nContent-Length: 9\n\nbody")
    assert (row["content_length"], row["content"]) == ("4", "body")


def test_empty_header_takes_the_next_line(spark):
    text = "WARC-Type: a\nWARC-Refers-To:\nWARC-Date: d\nContent-Length: 4\n\nbody"
    assert parse(spark, text)["refers_to"] == "WARC-Date: d"
    assert parse(spark, text, strict_headers=True)["refers_to"] is None


def test_quotes_and_spaces_around_values(spark):
    row = parse(spark, 'WARC-Type:  "a"  \nWARC-Date: "x y" \nContent-Length: 4\n\nbody')
    assert (row["rec_type"], row["warc_date"]) == ("a", "x y")


def test_empty_and_unicode_bodies(spark):
    assert parse(spark, "WARC-Type: a\r\nContent-Length: 0\r\n\r\n")["content"] == ""
    assert parse(spark, "WARC-Type: a\nContent-Length: 9\n\n　 hé\U0001f600  \n")["content"] == "hé\U0001f600"


def test_untyped_and_warcinfo_records_are_dropped(spark):
    texts = ["WARC-Date: d\nContent-Length: 1\n\nx", "WARC-Type: warcinfo\nContent-Length: 1\n\nx"]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    assert wet.parse_records(df).count() == 0
    assert wet.parse_all(df).where("parsed").count() == 2


def test_length_filter_ignores_text(spark):
    df = spark.createDataFrame([("31",), ("30",), ("abc",), (None,)], "content_length string")
    assert [r[0] for r in wet.longer_than(df).collect()] == ["31"]


def test_no_shuffle_and_no_python(spark, tmp_path, plan):
    write_plain(tmp_path / "a.wet", [page(1, "x")])
    text = plan(wet.wet_records(spark, str(tmp_path / "a.wet")))
    assert "Exchange" not in text and "Python" not in text


def test_header_names_round_trip(spark):
    df = spark.createDataFrame([tuple(RECORD_COLUMNS)], list(RECORD_COLUMNS))
    named = to_header_names(df)
    assert named.columns == list(RECORD_COLUMNS.values())
    assert to_canonical_names(named).columns == list(RECORD_COLUMNS)


def test_line_scan(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n")
    with gzip.open(tmp_path / "b.warc.gz", "wt") as f:
        f.write("three\n")
    paths = [str(tmp_path / "a.txt"), str(tmp_path / "b.warc.gz")]
    assert sorted(r["value"] for r in wet.line_scan(spark, paths).collect()) == ["one", "three", "two"]


def test_pruned_scan_still_parses(spark, sf):
    from crawlprism.registry.fixtures import record_texts

    ids = wet.parse_records(record_texts(spark, sf)).select(F.col("record_id"))
    assert ids.distinct().count() == spark.read.parquet(f"{sf}/documents.parquet").count()
