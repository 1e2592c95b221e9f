"""Benchmark decontamination by Wu-Manber search over words.

The benchmark's windows are the patterns; words are the symbols. For each pattern length there is
one searcher: a shift table over blocks of two words says how far the search may jump, a bucket
per suffix block and a prefix check select the patterns to test, and a direct comparison confirms.

Defined cases: null or empty text has no words, hits or items. Items without id or words have no
windows. Repeated rows of documents give repeated rows of the result; repeated items count once.
An empty benchmark hits nothing. Other columns of either table are not looked at.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlprism.llm.common import kept, map_batches, stored, text_bytes

WINDOW = 10

# Words of one piece of an item. Pieces overlap, so that no window is lost.
PIECE_WORDS = 4096

# The patterns of one pass. A larger benchmark takes several passes, each with its own tables.
BLOCK_BYTES = 8 * 1024 * 1024

_WORD = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TO_WORDS = bytes(
    (b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD else 0x20) for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Words after lower-casing A-Z: runs of 0-9, a-z and everything beyond ASCII."""
    return text.translate(_TO_WORDS).split()


class Searcher:
    """Wu-Manber tables for patterns of one length over integer symbols; symbol 0 is in no pattern."""

    def __init__(self, patterns: dict[tuple[int, ...], frozenset[str]], length: int):
        self.length = length
        self.block = min(2, length)
        self.shift: dict[tuple[int, ...], int] = {}
        self.buckets: dict[tuple[int, ...], dict[tuple[int, ...], list]] = defaultdict(lambda: defaultdict(list))
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                key = pattern[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, length), length - end)
            self.buckets[pattern[length - self.block :]][pattern[: self.block]].append((pattern, items))

    def find(self, symbols: list[int]) -> Iterator[tuple[int, frozenset[str]]]:
        """Start of each occurrence with the items it belongs to."""
        m, b, shift, buckets = self.length, self.block, self.shift, self.buckets
        default, end, n = m - b + 1, m, len(symbols)
        while end <= n:
            if not symbols[end - 1]:
                end += m
                continue
            suffix = tuple(symbols[end - b : end])
            jump = shift.get(suffix, default)
            if jump:
                end += jump
                continue
            start = end - m
            for pattern, items in buckets[suffix].get(tuple(symbols[start : start + b]), ()):
                if tuple(symbols[start:end]) == pattern:
                    yield start, items
            end += 1


class Patterns:
    """The windows of a set of item pieces, by length."""

    def __init__(self, pieces: Iterable[tuple[str, bytes]], window: int):
        self.symbol: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
        for item, text in pieces:
            ids = tuple(self.symbol.setdefault(w, len(self.symbol) + 1) for w in text.split())
            m = min(window, len(ids))
            for i in range(len(ids) - m + 1):
                by_length[m][ids[i : i + m]].add(item)
        self.searchers = [
            Searcher({p: frozenset(items) for p, items in group.items()}, m) for m, group in sorted(by_length.items())
        ]

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """(start, end) word spans of all occurrences, and the items that occur."""
        known = self.symbol.get
        symbols = [known(w, 0) for w in words]
        spans, items = [], set()
        for searcher in self.searchers:
            for start, found in searcher.find(symbols):
                spans.append((start, start + searcher.length))
                items |= found
        return spans, items


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def item_pieces(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """(item, piece): words joined by spaces, at most PIECE_WORDS + window - 1 of them."""

    def run(batches):
        for batch in batches:
            items, pieces = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                for at in range(0, max(len(words) - window + 1, 1), PIECE_WORDS):
                    if words:
                        items.append(item)
                        pieces.append(b" ".join(words[at : at + PIECE_WORDS + window - 1]))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(pieces, pa.binary())], ["item", "piece"])

    rows = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("string"), text_bytes(benchmark, text_col))
    return rows.mapInArrow(run, "item string, piece binary")


def _patterns(shared, key: str, window: int) -> Patterns:
    """Tables of one block, built once per worker; the worker keeps one block at a time."""
    return kept(("patterns", key, window), lambda: Patterns(shared.value, window))


HITS = "doc_id {id}, text_key binary, n_words bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>"


class _Blocks:
    """The benchmark's patterns in blocks of a measured size; one at a time comes to the driver and goes to the executors."""

    def __init__(self, benchmark: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int):
        self.pieces = item_pieces(benchmark, item_col, text_col, window)
        total = self.pieces.agg(F.sum(F.octet_length("piece") + F.octet_length("item"))).first()[0] or 0
        self.count = max(1, -(-total // block_bytes))

    def shared(self, i: int):
        part = self.pieces.where(F.pmod(F.xxhash64("item", "piece"), F.lit(self.count)) == i)
        found = [(r["item"], bytes(r["piece"])) for r in part.distinct().collect()]
        key = hashlib.md5(repr(sorted(found)).encode()).hexdigest()
        return self.pieces.sparkSession.sparkContext.broadcast(found), key


def _search(docs: DataFrame, shared, key: str, window: int, schema: str, hit_only: bool) -> DataFrame:
    def run(batches):
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        patterns = _patterns(shared, key, window)
        for batch in batches:
            keep, keys, counts, all_spans, all_items = [], [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                words = words_of(text)
                spans, items = patterns.hits(words)
                if hit_only and not items:
                    continue
                keep.append(row)
                keys.append(hashlib.md5(text).digest())
                counts.append(len(words))
                all_spans.append([{"start": a, "end": b} for a, b in merged(spans)])
                all_items.append(sorted(items))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(keep, pa.int64())),
                    pa.array(keys, pa.binary()),
                    pa.array(counts, pa.int64()),
                    pa.array(all_spans, spans_type),
                    pa.array(all_items, pa.list_(pa.string())),
                ],
                ["doc_id", "text_key", "n_words", "spans", "items"],
            )

    return docs.mapInArrow(run, schema)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per document row: its words, the merged word spans of benchmark windows, and the item ids (as strings).

    The patterns are sent to the executors in blocks of a measured size. One block needs no shuffle.
    Each further block is a pass of its own over the documents, and only rows with hits meet in a shuffle.
    """
    blocks = _Blocks(benchmark, item_col, item_text_col, window, block_bytes)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = HITS.format(id=kind)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_bytes(docs, text_col).alias("text"))

    first = _search(rows, *blocks.shared(0), window, schema, hit_only=False)
    if blocks.count == 1:
        return first.drop("text_key")
    # a key for rows without id, so that they meet their own hits
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_key")
    rest = reduce(DataFrame.unionByName, [_search(rows, *blocks.shared(i), window, schema, hit_only=True) for i in range(1, blocks.count)])
    more = (
        rest.select(name, "text_key", "spans", "items")
        .groupBy("doc_key", "text_key")
        .agg(F.flatten(F.collect_set("spans")).alias("more_spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("more_items"))
    )
    both = first.withColumn("doc_key", name).join(more, ["doc_key", "text_key"], "left")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    spans = F.array_sort(F.concat("spans", F.coalesce("more_spans", none)))
    # merge sorted spans that touch
    step = lambda acc, s: F.when(
        (F.size(acc) > 0) & (s["start"] <= F.element_at(acc, -1)["end"]),
        F.concat(
            F.slice(acc, 1, F.size(acc) - 1),
            F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"))),
        ),
    ).otherwise(F.concat(acc, F.array(s)))
    return both.select(
        "doc_id",
        "n_words",
        F.when(F.col("more_spans").isNull(), F.col("spans")).otherwise(F.aggregate(spans, none, step)).alias("spans"),
        F.array_sort(F.array_union("items", F.coalesce("more_items", F.array().cast("array<string>")))).alias("items"),
    )


def keep_clean(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows, all columns, in which no window of the benchmark occurs. No shuffle; one pass for each block of patterns."""
    blocks = _Blocks(benchmark, item_col, item_text_col, window, block_bytes)
    place = docs.columns.index(text_col)

    def passed(rows: DataFrame, shared, key: str) -> DataFrame:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            patterns = _patterns(shared, key, window)
            clean = [not patterns.hits(words_of((t or "").encode()))[1] for t in batch.column(place).to_pylist()]
            return batch.filter(pa.array(clean, pa.bool_()))

        return map_batches(rows, run, rows.schema)

    for i in range(blocks.count):
        docs = passed(docs, *blocks.shared(i))
        if i + 1 < blocks.count:
            docs = stored(docs, "decontaminated")
    return docs


def digest(found: DataFrame) -> DataFrame:
    """The result columns of the query, from ``contamination``."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x["end"] - x["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


_WORDS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, g, len(g) AS m FROM (
    SELECT item_id, unnest([w[i:i + least(len(w), {WINDOW}) - 1] FOR i IN range(1, len(w) - least(len(w), {WINDOW}) + 2)]) AS g
    FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT m FROM win),
grams AS (
  SELECT rid, m, i, w[i:i + m - 1] AS g
  FROM (SELECT rid, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM d, lens)),
hit AS (SELECT rid, m, i, item_id FROM grams JOIN win USING (m, g)),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + m)) AS p FROM hit) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN items USING (rid)
"""
