"""URL filters against plain rules and a plain set of listed URLs."""

from __future__ import annotations

import re

import numpy as np
import pytest
from common import rows

from crawlprism.llm import url_filter
from crawlprism.llm.common import bound_batches

ODD = [
    None, "", "no scheme", "http://", "http://EXAMPLE.net/en/x?y#z", "https://a.example.net/en/", "http://example.net", "http://example.net/en", "http://xexample.net/en/",
    "http://net/", "http://a.net/de/", "http://example.com/de/1", "http://b.a.example.com/de/", "http://example.com/DE/", "http://x.org/fr/", "http://org/fr/?q", "a://b://c.net/x",
    "http://x.net?/en/", "http://x.net#/", "://x.net/", "http://É.net/", "http://u@WWW.Free-Bets.example.com:80//a//?b=2&a=1&utm_source=x#t", "http://free-bets.example.com/a?a=1&b=2",
    "http://free-bets.example.com/a", "http://free-bets.example.com/a", "http://other.example.com/a?ref=1", "http://x.com/" + "y" * 100_000, "http://x.com/a\nb?c",
]


def plain_parts(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return low, re.match(r"[^?#]*", rest[len(host) :])[0]


def plain_key(url):
    host, path = plain_parts(url)
    if "://" not in (url or ""):
        return None
    host = re.sub(r"^[^@]*@", "", host)
    host = re.sub(r"\.?(:80|:443)?\Z", "", re.sub(r"^(www\.|m\.)", "", host))
    query = re.match(r"[^?#]*(?:\?([^#]*))?", url[url.find("://") + 3 :])[1] or ""
    parts = sorted(p for p in query.split("&") if p and not re.match(r"(utm_[^=]*|ref|gclid|fbclid)(=|\Z)", p))
    return host + re.sub("/\\Z", "", re.sub("/{2,}", "/", path)) + ("?" + "&".join(parts) if parts else "")


def plain(urls, listed):
    keys = {plain_key(u) for u in listed} - {None}
    out = []
    for i, url in urls:
        host, path = plain_parts(url)
        fitting = [r for r in url_filter.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fitting, key=lambda r: len(r[0] + r[1]), default=None)
        verdict = best[2] if best else "block" if plain_key(url) in keys else "allow"
        out.append((i, host, path, best and best[0] + best[1], verdict))
    return sorted(out, key=repr)


@pytest.mark.parametrize("segment_bytes", [url_filter.SEGMENT_BYTES, 1])
def test_odd_urls(spark, segment_bytes, monkeypatch):
    bound_batches(spark)
    monkeypatch.setattr(url_filter, "BITS_PER_KEY", 10**7 if segment_bytes == 1 else 16)
    urls = [(i if i % 7 else None, u) for i, u in enumerate(ODD * 2)]
    listed = [u for u in ODD if u and "free-bets" in u.lower()] + ["http://other.example.com/a", None, "x"]
    df = spark.createDataFrame([(i, u, "k", 1) for i, u in urls], "page_id bigint, url string, key string, h int")
    got = url_filter.verdicts(df, url_filter.listed_urls(spark.createDataFrame([(u,) for u in listed], "url string")), segment_bytes=segment_bytes)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(urls, listed)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]


def test_pages(spark):
    bound_batches(spark)
    pages = rows("pages", "/root/testdata/sf0.01")
    df = spark.createDataFrame([(r["page_id"], r["url"]) for r in pages], "page_id bigint, url string")
    listed = [r["url"] for r in pages if re.search("casino-win|free-bets|cheap-pills|ads-track", r["url"])]
    got = url_filter.verdicts(df, url_filter.listed_urls(url_filter.pages_of_sites(df))).collect()
    assert sorted(map(tuple, got), key=repr) == plain([(r["page_id"], r["url"]) for r in pages], listed)
    assert any(r["rule"] is None and r["verdict"] == "block" for r in got)


def test_empty_tables(spark):
    bound_batches(spark)
    none = spark.createDataFrame([], "page_id bigint, url string")
    some = spark.createDataFrame([(1, "http://x.com/")], "page_id bigint, url string")
    assert url_filter.verdicts(none, url_filter.listed_urls(some)).collect() == []
    assert [r["verdict"] for r in url_filter.verdicts(some, url_filter.listed_urls(none)).collect()] == ["allow"]


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    bound_batches(spark)
    pick = np.random.default_rng(0)
    hashes = np.unique(pick.integers(-(2**63), 2**63 - 1, 200_000))
    n_blocks = url_filter.n_blocks_for(len(hashes))
    keys = spark.createDataFrame([(int(h),) for h in hashes], "h bigint")
    slices = sorted(url_filter.slices(keys, n_blocks).collect())
    bits = np.concatenate([np.frombuffer(r["bits"], np.uint32) for r in slices]).reshape(-1, 8)
    assert len(bits) == n_blocks
    assert url_filter.hits(bits, url_filter.block_of(hashes, n_blocks), hashes).all()
    others = pick.integers(-(2**63), 2**63 - 1, 200_000)
    assert url_filter.hits(bits, url_filter.block_of(others, n_blocks), others).mean() < 0.005
