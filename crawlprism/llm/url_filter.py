"""URL filters: rules of hosts and paths, then a list of canonical URLs behind a blocked Bloom filter.

A listed URL is found in two steps. The filter is split into blocks of 256 bits, eight words of which each hold one bit of a key,
so a test looks at 32 neighbouring bytes. Pages that it passes, the listed ones and a few others, meet the list itself in a hash
join on the canonical URL, which removes the false positives. Pages that it stops are never shuffled.

The filter is built from hashes dealt by slice of blocks. It is broadcast in segments of at most ``SEGMENT_BYTES``: a
longer list takes further passes over the URLs, each with its own segment, so the broadcast does not grow with the list. The
driver holds one segment at a time.

Rules are settings, a few (host, path, action) triples, compiled to one expression. A rule fits its host and all subdomains, where
the URL's path starts with the rule's. The longest fitting rule wins, of equally long ones that with the longer host. Where none
fits, listed pages are blocked and others allowed.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits no rule, is not listed and is allowed; null ids
and repeated rows stay as they are; an empty list blocks nothing; an empty table gives an empty result; URLs of any length are
taken whole; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlprism.llm.common import stored
from crawlprism.session import shuffle_width

Rule = tuple[str, str, str]

RULES: list[Rule] = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]

# Site names whose pages the query's list takes up.
LISTED_SITES = ["casino-win", "free-bets", "cheap-pills", "ads-track"]

# Query parameters that do not tell pages apart.
TRACKING = ["utm_[^=]*", "ref", "gclid", "fbclid"]

BITS_PER_KEY = 16
SLICE_BLOCKS = 32 * 1024
SEGMENT_BYTES = 32 * 1024 * 1024
BLOCK_BYTES = 32

# The odd multipliers of the split block filter in the Parquet format.
SALTS = np.array(
    [0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31], np.uint32
)


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))


def host(url: Column) -> Column:
    return F.coalesce(_ascii_lower(F.regexp_extract(_rest(url), "^[^/?#]*", 0)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """One spelling for the URLs of a page; null where there is no ``://``.

    Gone are the scheme, a user name, ``www.`` or ``m.``, default ports, doubled and last slashes, the fragment and
    tracking parameters; the host is in lower case and the other parameters are sorted.
    """
    site = F.regexp_replace(F.regexp_replace(host(url), "^[^@]*@", ""), r"^(www\.|m\.)|\.?(:80|:443)?$", "")
    place = F.regexp_replace(F.regexp_replace(path(url), "/{2,}", "/"), "/$", "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    parts = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^({'|'.join(TRACKING)})(=|$)")))
    tail = F.when(F.size(parts) > 0, F.concat(F.lit("?"), F.array_join(parts, "&"))).otherwise("")
    return F.when(_rest(url).isNotNull(), F.concat(site, place, tail))


def rule_columns(site: Column, place: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The winning rule as ``host + path`` and its action; both null where none fits."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, rule_action in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]), r)):
        fits = ((site == rule_host) | site.endswith("." + rule_host)) & place.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        action = F.when(fits, rule_action).otherwise(action)
    return name, action


def block_of(hashes: np.ndarray, n_blocks: int) -> np.ndarray:
    """The block of each 64-bit hash, by its upper half."""
    high = hashes.view(np.uint64) >> np.uint64(32)
    return ((high * np.uint64(n_blocks)) >> np.uint64(32)).astype(np.int64)


def masks(hashes: np.ndarray) -> np.ndarray:
    """Eight words for each hash, with one bit set in each, by its lower half."""
    low = (hashes.view(np.uint64) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return np.uint32(1) << ((low[:, None] * SALTS[None, :]) >> np.uint32(27))


def hits(bits: np.ndarray, blocks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    wanted = masks(hashes)
    return ((bits[blocks] & wanted) == wanted).all(axis=1)


def n_blocks_for(n_keys: int) -> int:
    return max(1, -(-n_keys * BITS_PER_KEY // (8 * BLOCK_BYTES)))


def slices(keys: DataFrame, n_blocks: int) -> DataFrame:
    """The filter as rows (slice, bits) of at most SLICE_BLOCKS blocks, from a frame of distinct hashes ``h``."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = block_of(batch.column(0).to_numpy(zero_copy_only=False), n_blocks)
            yield pa.RecordBatch.from_arrays([pa.array(at // SLICE_BLOCKS), batch.column(0)], ["slice", "h"])

    def build(group: pa.Table) -> pa.Table:
        first = group.column("slice")[0].as_py()
        hashes = group.column("h").to_numpy()
        bits = np.zeros((min(SLICE_BLOCKS, n_blocks - first * SLICE_BLOCKS), len(SALTS)), np.uint32)
        blocks = block_of(hashes, n_blocks) - first * SLICE_BLOCKS
        wanted = masks(hashes)
        for lane in range(len(SALTS)):
            np.bitwise_or.at(bits[:, lane], blocks, wanted[:, lane])
        return pa.table({"slice": pa.array([first], pa.int64()), "bits": pa.array([bits.tobytes()], pa.binary())})

    return keys.select("h").mapInArrow(number, "slice bigint, h bigint").groupBy("slice").applyInArrow(build, "slice bigint, bits binary")


def possible(urls: DataFrame, filter_slices: DataFrame, n_blocks: int, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The rows of ``urls`` with ``h`` replaced by ``maybe``: whether the filter passes the hash. A null hash does not pass."""
    spark = urls.sparkSession
    at_once = max(1, segment_bytes // (SLICE_BLOCKS * BLOCK_BYTES))
    n_slices = -(-n_blocks // SLICE_BLOCKS)
    columns = [f for f in urls.schema.fields if f.name != "h"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in columns), "maybe boolean"])
    passes = []
    for begin in range(0, n_slices, at_once):
        end = min(begin + at_once, n_slices)
        size = (min(end * SLICE_BLOCKS, n_blocks) - begin * SLICE_BLOCKS) * BLOCK_BYTES
        segment = bytearray(size)
        for row in filter_slices.where(F.col("slice").between(begin, end - 1)).toLocalIterator():
            place = (row["slice"] - begin) * SLICE_BLOCKS * BLOCK_BYTES
            segment[place : place + len(row["bits"])] = row["bits"]
        shared = spark.sparkContext.broadcast(bytes(segment))
        lower, upper = begin * SLICE_BLOCKS, min(end * SLICE_BLOCKS, n_blocks)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, lower=lower, upper=upper) -> Iterator[pa.RecordBatch]:
            bits = np.frombuffer(shared.value, np.uint32).reshape(-1, len(SALTS))
            for batch in batches:
                h = batch.column(batch.schema.get_field_index("h"))
                known = h.is_valid().to_numpy(zero_copy_only=False)
                hashes = h.fill_null(0).to_numpy(zero_copy_only=False)
                blocks = block_of(hashes, n_blocks)
                here = (blocks >= lower) & (blocks < upper) if known.any() else np.zeros(len(blocks), bool)
                mine = here & known if lower else (here & known) | ~known  # rows without a hash leave with the first pass
                maybe = np.zeros(len(blocks), bool)
                look = here & known
                maybe[look] = hits(bits, blocks[look] - lower, hashes[look])
                rest = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "h"]
                names = [name for name in batch.schema.names if name != "h"]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(maybe)], [*names, "maybe"]).filter(pa.array(mine))

        passes.append(stored(urls.mapInArrow(run, schema), "url-possible"))
        shared.destroy()
    out = passes[0]
    for more in passes[1:]:
        out = out.unionByName(more)
    return out


def listed_urls(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """The distinct canonical URLs of a list, with their hashes, stored."""
    keys = urls.select(canonical(F.col(url_col).cast("string")).alias("key")).where(F.col("key").isNotNull()).distinct()
    return stored(keys.select("key", F.xxhash64("key").alias("h")), "url-list")


def verdicts(
    pages: DataFrame,
    listed: DataFrame,
    rules: list[Rule] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    segment_bytes: int = SEGMENT_BYTES,
) -> DataFrame:
    """``id_col``, host, path, rule and verdict of each row; ``listed`` is what ``listed_urls`` gives."""
    url = F.col(url_col).cast("string")
    judged = pages.select(F.col(id_col).alias("id"), url.alias("u")).select(
        "id", host(F.col("u")).alias("host"), path(F.col("u")).alias("path"), canonical(F.col("u")).alias("key")
    )
    rule, action = rule_columns(F.col("host"), F.col("path"), rules)
    judged = judged.select("id", "host", "path", rule.alias("rule"), action.alias("action"), "key")
    # a page that a rule decides needs no look at the list
    judged = judged.withColumn("key", F.when(F.col("rule").isNull(), F.col("key")))
    judged = judged.withColumn("h", F.when(F.col("key").isNotNull(), F.xxhash64("key")))
    n_blocks = n_blocks_for(listed.count())
    # two distinct URLs may share a hash; a hash sets its bits once
    tested = possible(judged, stored(slices(listed.select("h").distinct(), n_blocks), "url-filter"), n_blocks, segment_bytes)
    sure = tested.where(~F.col("maybe")).withColumn("found", F.lit(False))
    # both sides are stored, so Spark can split a key that many pages share
    found = listed.select(F.col("key"), F.lit(True).alias("hit"))
    checked = tested.where("maybe").join(found, "key", "left").withColumn("found", F.col("hit").isNotNull()).drop("hit")
    verdict = F.coalesce("action", F.when(F.col("found"), "block").otherwise("allow"))
    return sure.unionByName(checked).select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"))


def pages_of_sites(pages: DataFrame, sites: list[str] = LISTED_SITES, url_col: str = "url") -> DataFrame:
    """The rows whose host has one of the names as a label: the query's stand-in for a published list."""
    return pages.where(host(F.col(url_col)).rlike(rf"(^|\.)({'|'.join(sites)})\."))


def _sql_rest(u: str) -> str:
    return f"(CASE WHEN instr({u}, '://') > 0 THEN substr({u}, instr({u}, '://') + 3) END)"


SQL = rf"""
WITH p AS (SELECT page_id, {_sql_rest("url")} AS rest FROM pages),
q AS (
  SELECT page_id, rest, coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
    list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^({"|".join(TRACKING)})(=|$)'))) AS parts
  FROM p),
c AS (
  SELECT page_id, host, path, CASE WHEN rest IS NOT NULL THEN
    regexp_replace(regexp_replace(host, '^[^@]*@', ''), '^(www\.|m\.)|\.?(:80|:443)?$', '', 'g')
    || regexp_replace(regexp_replace(path, '/{{2,}}', '/', 'g'), '/$', '')
    || CASE WHEN len(parts) > 0 THEN '?' || array_to_string(parts, '&') ELSE '' END END AS key
  FROM q),
l AS (SELECT DISTINCT key FROM c WHERE regexp_matches(host, '(^|\.)({"|".join(LISTED_SITES)})\.') AND key IS NOT NULL),
r(rule_host, rule_path, action) AS (VALUES {", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in RULES)}),
f AS (
  SELECT c.page_id, c.host, c.path, c.key, (
    SELECT max({{'n': length(rule_host || rule_path), 'h': length(rule_host), 'rule': rule_host || rule_path, 'action': action}}) FROM r
    WHERE (c.host = rule_host OR ends_with(c.host, '.' || rule_host)) AND starts_with(c.path, rule_path)) AS best
  FROM c)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.action, CASE WHEN l.key IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM f LEFT JOIN l ON l.key = f.key
"""
