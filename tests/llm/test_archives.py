"""Archives: round trip, standard form, chunks, awkward rows."""

import base64
import gzip
import hashlib
import io
import zlib
from pathlib import Path

from common import same
from pyspark.sql import functions as F

from crawlprism.llm import warc as W
from crawlprism.llm.common import scratch_path

BIG = "".join(f"<p>{i * i}</p>" for i in range(120_000))  # several chunks
PAGES = [
    (1, "http://a/", "same"), (2, "http://b/ x\r\ny", "same"), (3, None, "same"), (4, "http://c/", None), (5, "http://d/", ""),
    (6, "http://e/", BIG), (7, "http://f/", BIG), (8, "http://g/", "é中\r\n\r\nWARC/1.1"), (None, "http://h/", "only"), (None, "http://i/", "same"),
    (9, "http://j/", "twice"), (9, "http://j/", "twice"),
]


def pages(spark, data=PAGES):
    frame = spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in data], "page_id bigint, url string, html string, record_type string, size int")
    return frame.repartition(3)


def plain(data):
    best = {}
    for i, _, h in data:
        if i is not None:
            best[h or ""] = max(i, best.get(h or "", i))
    out = []
    for i, _, h in data:
        body = (h or "").encode()
        winner = best.get(h or "")
        revisit = winner is not None and i != winner
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((i, len(body), digest, "revisit" if revisit else "response", winner if revisit else None))
    return out


def test_round_trip(spark):
    same(W.archive_round_trip(pages(spark)).collect(), plain(PAGES))


def test_empty_table(spark):
    assert W.archive_round_trip(pages(spark, [])).collect() == []


def test_chunks_and_form(spark):
    folder = scratch_path(spark, "warc-test")
    manifest = W.write_archives(W.planned_records(W.chunked(pages(spark), chunk_bytes=70_000), W.winners(pages(spark))), folder)
    chunks = W.read_archives(manifest, chunk_bytes=50_000).collect()
    body = b"".join(bytes(r.data) for r in sorted((r for r in chunks if r.id == "7"), key=lambda r: r.chunk))
    assert body == BIG.encode() and max(len(r.data) for r in chunks) <= 50_000
    assert [r.digest is not None for r in sorted((r for r in chunks if r.id == "7"), key=lambda r: r.chunk)][-1]
    files = [Path(r.path.removeprefix("file:")) for r in manifest.select("path").distinct().collect()]
    records = 0
    for file in files:
        packed = file.read_bytes()
        assert gzip.decompress(packed).startswith(b"WARC/1.1\r\n")
        while packed:  # one gzip member for each record
            one = zlib.decompressobj(31)
            data = one.decompress(packed) + one.flush()
            packed, records = one.unused_data, records + 1
            head, _, block = data.partition(b"\r\n\r\n")
            fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
            assert len(block) == int(fields[b"Content-Length"]) + 4 and block.endswith(b"\r\n\r\n")
            assert b"\n" not in fields.get(b"WARC-Target-URI", b"")
            if fields[b"WARC-Type"] == b"revisit":
                assert {b"WARC-Refers-To", b"WARC-Profile"} <= set(fields)
    assert records == len(PAGES)


def test_min_revisit_bytes(spark):
    planned = W.planned_records(W.chunked(pages(spark)), W.winners(pages(spark)), min_revisit_bytes=100)
    types = {r.id: r.refers_to for r in planned.collect()}
    assert types["1"] is None and types["6"] == "7"


def test_chunks_move_and_hot_payloads_can_be_split(spark, plan):
    sizes = W.chunked(pages(spark), chunk_bytes=1000).select("record", F.length("data").alias("n"), "n_chunks", "size")
    assert all(r.n <= 1000 for r in sizes.collect())
    assert sizes.where("record is not null").groupBy("record").agg(F.sum("n").alias("n"), F.first("size").alias("size")).where("n <> size").count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shape = plan(W.planned_records(W.chunked(pages(spark)), W.winners(pages(spark))))
        planned = W.planned_records(W.chunked(pages(spark), chunk_bytes=1000), W.winners(pages(spark))).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # both sides are plain shuffles: no aggregate stands between the join and its exchange
    assert "SortMergeJoin" in shape and "HashAggregate" not in shape
    # a record's chunks follow one another in order, also of rows that are equal
    left = 0
    for r in planned:
        assert r.chunk == (0 if left == 0 else n - left)
        if left == 0:
            left = n = r.n_chunks
        left -= 1
    assert left == 0


def test_stream_reports_a_cut_archive():
    out = io.BytesIO()
    row = ("1", "u", hashlib.sha1(b"abc").hexdigest(), 3, None, 1, 0, b"abc")
    list(W._write(iter([row]), out))
    cut = io.BytesIO(out.getvalue()[:-20])
    try:
        list(W._records(W._Stream(cut, 0, len(cut.getvalue())), 10))
    except ValueError:
        return
    raise AssertionError("a cut archive was read")
