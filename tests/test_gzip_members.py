"""Archives of gzip members read in ranges against the whole file at once."""

import gzip
import random
import zlib

import pytest

from crawlprism.registry import registry
from crawlprism.registry.fixtures import record_texts
from crawlprism.sources import gzip_members as G
from crawlprism.sources import wet

MARK = b"WARC/1.0\r\n"


def record(i: int, body: bytes) -> bytes:
    return MARK + b"WARC-Record-ID: <urn:uuid:%d>\r\nContent-Length: %d\r\n\r\n" % (i, len(body)) + body + b"\r\n\r\n"


def bodies():
    pick = random.Random(3)
    out = [b"", b"plain", G._MEMBER * 50, gzip.compress(b"WARC/1.0 within"), b"line\nends in WARC/1.0\r\nWARC/1.0\n", "é中".encode(), b"\xff\x00\xfe"]
    out += [bytes(pick.randrange(256) for _ in range(pick.choice([10, 2_000, 40_000]))) for _ in range(60)]
    return out


def read(spark, path, range_bytes):
    files = G.archive_files(spark, str(path))
    rows = G.gzip_record_scan(files, range_bytes=range_bytes).selectExpr("cast(value as binary) as value").collect()
    return sorted(bytes(r["value"]).rstrip(b"\r\n") for r in rows)


@pytest.fixture(scope="module")
def whole():
    return [record(i, body) for i, body in enumerate(bodies())]


@pytest.mark.parametrize("range_bytes", [700, 20_000, 10**9])
def test_one_member_for_each_record(spark, tmp_path, whole, range_bytes):
    (tmp_path / "a.warc.wet.gz").write_bytes(b"".join(gzip.compress(r) for r in whole))
    (tmp_path / "b.warc.wet.gz").write_bytes(b"".join(gzip.compress(r) for r in whole[:3]) + b"\x00" * 512)
    (tmp_path / "empty.gz").write_bytes(b"")
    want = sorted(r.removeprefix(MARK).rstrip(b"\r\n") for r in [*whole, *whole[:3]])
    assert read(spark, tmp_path, range_bytes) == want


@pytest.mark.parametrize("range_bytes", [5_000, 10**9])
def test_other_cuts_into_members(spark, tmp_path, whole, range_bytes):
    """One member for all, and members that begin anywhere in a record."""
    data = b"".join(whole)
    (tmp_path / "one.gz").write_bytes(gzip.compress(data))
    pick = random.Random(4)
    cuts = sorted(pick.sample(range(1, len(data)), 40))
    (tmp_path / "cut.gz").write_bytes(b"".join(gzip.compress(data[a:b]) for a, b in zip([0, *cuts], [*cuts, len(data)])))
    want = sorted(2 * [r.removeprefix(MARK).rstrip(b"\r\n") for r in whole])
    assert read(spark, tmp_path, range_bytes) == want


def test_broken_files_are_errors(spark, tmp_path, whole):
    (tmp_path / "short.gz").write_bytes(gzip.compress(whole[5])[:-9])
    with pytest.raises(Exception, match="ends within a member"):
        read(spark, tmp_path / "short.gz", 10**9)
    (tmp_path / "text.gz").write_bytes(b"no gzip")
    with pytest.raises(Exception, match="is no gzip file"):
        read(spark, tmp_path / "text.gz", 10**9)


def test_bytes_that_look_like_a_member_are_passed_over():
    assert G._begins_record(gzip.compress(b"WARC/1.0\r\n"))
    assert not G._begins_record(G._MEMBER + b"\x00" * 20) and not G._begins_record(gzip.compress(b"other")) and not G._begins_record(b"")
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    assert G._begins_record(packer.compress(MARK * 10_000) + packer.flush())


def test_more_tasks_than_files(spark, sf, tmp_path):
    """One file is read by several tasks, and each record by one of them."""
    files = G.write_archives(record_texts(spark, sf).coalesce(1), str(tmp_path / "wet"))
    assert files.count() == 1
    scan = G.gzip_record_scan(files, range_bytes=16 * 1024)
    tasks = scan.selectExpr("spark_partition_id() as p").groupBy("p").count().collect()
    assert len(tasks) > 3
    assert sorted(r[0] for r in wet.parse_records(scan).select("record_id").collect()) == sorted(
        r[0] for r in registry["wet_parse"].build(spark, sf).select("record_id").collect()
    )
