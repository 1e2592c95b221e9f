"""Near duplicates by fast similarity sketching, banding and exact verification.

A sketch has a fixed number of bins. In each round every shingle is thrown into one bin; a bin keeps the
smallest value of the first round that reached it, and late rounds give each bin to all shingles, so that every
coordinate is filled. Bands of coordinates are bucket keys. Candidates are confirmed on full shingle sets.

Texts with the same set are one class, so copies never meet in pairs. Within a bucket, classes are first
compared with the bucket's smallest class only. Then members that these links have not yet joined are compared with
the members of other components of their bucket, which is exact and leaves nothing to do in a group that has already
been joined. In a small bucket they are compared pair by pair; the members of large buckets are searched in a grid of
blocks. No bucket is capped.

Defined cases: a null text, or one without words, has an empty set, is linked with nothing and is kept. A row is a
document: rows with the same id and text are in one class. A row without id takes part, but names no component; if its
component has no id at all, its component_id is null and it is kept. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlprism.llm.common import kept, map_batches, stored, text_bytes
from crawlprism.llm.graph import components

# 40 bands of 5: a pair at similarity 0.8 is missed with a probability of 1.2e-7.
BANDS = 40
BAND_ROWS = 5
MIN_SIMILARITY_PERCENT = 80

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_C1, _C2, _GOLDEN = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_ROUND_SHIFT = np.uint64(44)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


# Words whose hash a worker remembers; others are hashed each time.
CACHED_WORDS = 1 << 17


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        code = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHED_WORDS:
            self[word] = code
        return code


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a shorter text is one shingle."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(kept(("near-words",), _Words).__getitem__, words), np.uint64, len(words))
    width = min(width, len(codes))
    folded = np.full(len(codes) - width + 1, width, np.uint64)
    for j in range(width):
        folded = _mix(folded * _GOLDEN + codes[j : len(codes) - width + 1 + j])
    return np.unique(folded)


def sketch(items: np.ndarray, bins: int) -> np.ndarray:
    """The coordinates: the round a bin was filled in and the smallest value it got there."""
    out = np.full(bins, _EMPTY, np.uint64)
    n, begin = len(items), 0
    with np.errstate(over="ignore"):
        while begin < bins and (out == _EMPTY).any():
            # as many rounds at once as it takes to fill all bins, most of the time
            rounds = np.arange(begin, min(bins, begin + max(1, 7 * bins // n)), dtype=np.uint64)[:, None]
            z = _mix(items[None, :] + (rounds + np.uint64(1)) * _GOLDEN)
            place = ((z & np.uint64(0xFFFFF)) * np.uint64(bins)) >> np.uint64(20)
            np.minimum.at(out, place.ravel().astype(np.int64), ((rounds << _ROUND_SHIFT) | (z >> np.uint64(20))).ravel())
            begin += len(rounds)
        for i in np.flatnonzero(out == _EMPTY):
            z = _mix(items + np.uint64(bins + int(i) + 1) * _GOLDEN)
            out[i] = (np.uint64(bins + int(i)) << _ROUND_SHIFT) | (z >> np.uint64(20)).min()
    return out


def band_keys(coordinates: np.ndarray, bands: int) -> np.ndarray:
    rows = coordinates.reshape(bands, -1)
    key = np.arange(bands, dtype=np.uint64)
    for j in range(rows.shape[1]):
        key = _mix(key * _GOLDEN + rows[:, j])
    return key.view(np.int64)


def _set_key(items: np.ndarray) -> bytes:
    a, b = _mix(items), _mix(items ^ _GOLDEN)
    return np.array([a.sum(dtype=np.uint64), b.sum(dtype=np.uint64)], np.uint64).tobytes()


def sketched(docs: DataFrame, id_col: str, text_col: str, width: int, bands: int, band_rows: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, keys, found = [], [], []
        for text in batch.column(2).to_pylist():
            items = shingles(text, width)
            sizes.append(len(items))
            keys.append(_set_key(items) if len(items) else None)
            found.append(band_keys(sketch(items, bands * band_rows), bands) if len(items) else None)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(found, pa.list_(pa.int64()))],
            ["doc_id", "text_key", "n_shingles", "set_key", "bands"],
        )

    kind = docs.schema[id_col].dataType.simpleString()
    text = text_bytes(docs, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.md5(text)).alias("text_key"), text.alias("text"))
    return map_batches(rows, run, f"doc_id {kind}, text_key binary, n_shingles bigint, set_key binary, bands array<bigint>")


def _sets(docs: DataFrame, text_col: str, wanted: DataFrame, width: int) -> DataFrame:
    """(cid, size, items) of the wanted classes, from one text of each."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingles(t, width) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())],
            ["cid", "size", "items"],
        )

    text = text_bytes(docs, text_col)
    texts = docs.select(F.unhex(F.md5(text)).alias("text_key"), text.alias("text")).join(wanted, "text_key")
    # copies of the text that stands for a class give the same row again
    once = map_batches(texts.select("cid", "text"), run, "cid bigint, size bigint, items binary")
    return stored(once.dropDuplicates(["cid"]), "near-sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
            both = np.sort(np.concatenate([x, y]), kind="stable")
            shared = int((both[1:] == both[:-1]).sum())
            keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
        return batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("cid").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("cid").alias("b"), F.col("items").alias("y"))
    full = pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y")
    return map_batches(full, run, "a bigint, b bigint")


# A bucket of so many classes is searched in blocks; smaller ones give less than half its square in pairs.
LARGE_BUCKET = 64

# Classes on either side of one block of the search.
CELL = 256


def _searched(crowded: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of the rows (family, cid, label) that are not of the family's own component, without a row for each pair.

    They are the queries; all rows of the family are searched. Both are dealt to a grid of cells of about CELL by
    CELL, so that a family of any size is spread. A cell indexes its rows by shingle and counts, for each query, what
    it shares with each. It gives one link for each component that a query is linked with.
    """
    sizes = crowded.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") != F.col("family")).alias("q"))
    grid = sizes.select("family", F.ceil(F.col("n") / CELL).cast("int").alias("rows"), F.ceil(F.col("q") / CELL).cast("int").alias("columns"))
    placed = crowded.join(grid, "family").join(sets, "cid")
    spot = F.xxhash64("cid", "family")

    def across(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    every = placed.withColumns({"i": F.pmod(spot, "rows").cast("int"), "j": across("columns")})
    queries = placed.where(F.col("label") != F.col("family")).withColumns({"j": F.pmod(spot, "columns").cast("int"), "i": across("rows")})
    cell = ["family", "i", "j"]
    wanted = [*cell, "cid", "label", "items"]

    def run(here: pa.Table, asked: pa.Table) -> pa.Table:
        a, b = [], []
        if len(here) and len(asked):
            ids, labels = here.column("cid").to_pylist(), np.array(here.column("label").to_pylist(), np.int64)
            items = [np.frombuffer(x, np.uint64) for x in here.column("items").to_pylist()]
            counts = np.array([len(x) for x in items])
            shingle, owner = np.concatenate(items), np.repeat(np.arange(len(items)), counts)
            order = np.argsort(shingle, kind="stable")
            shingle, owner = shingle[order], owner[order]
            for cid, label, raw in zip(*(asked.column(c).to_pylist() for c in ("cid", "label", "items"))):
                own = np.frombuffer(raw, np.uint64)
                first, last = np.searchsorted(shingle, own, "left"), np.searchsorted(shingle, own, "right")
                n = last - first
                places = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
                shared = np.bincount(owner[places], minlength=len(items))
                near = np.flatnonzero((100 * shared >= percent * (counts + len(own) - shared)) & (labels != label))
                for k in near[np.unique(labels[near], return_index=True)[1]].tolist():
                    a.append(cid)
                    b.append(ids[k])
        return pa.Table.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return every.select(wanted).groupBy(cell).cogroup(queries.select(*[F.col(c).alias(c) for c in wanted]).groupBy(cell)).applyInArrow(run, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = MIN_SIMILARITY_PERCENT,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
    large_bucket: int = LARGE_BUCKET,
) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, kept) of every row; ``text_key`` is the text's MD5."""
    base = stored(sketched(docs, id_col, text_col, width, bands, band_rows), "near-sketch")
    classes = stored(
        base.where(F.col("n_shingles") > 0)
        .groupBy("set_key")
        .agg(
            F.min("doc_id").alias("min_id"), F.min("text_key").alias("text_key"),
            F.first("n_shingles").alias("size"), F.first("bands").alias("bands"),
        )
        .withColumn("cid", F.monotonically_increasing_id()),
        "near-classes",
    )
    buckets = classes.select("cid", "size", F.explode("bands").alias("key"))
    # an aggregate that is joined with its own rows is stored first: both sides of the join are then plain shuffles, whose
    # large partitions Spark can split
    hubs = stored(
        buckets.groupBy("key")
        .agg(F.min(F.struct("cid", "size")).alias("hub"), F.count(F.lit(1)).alias("members"))
        .where(F.col("members") > 1)
        .select("key", F.col("hub.cid").alias("hub"), F.col("hub.size").alias("hub_size")),
        "near-hubs",
    )
    members = stored(buckets.join(hubs, "key"), "near-members")
    wanted = classes.join(members.select("cid").distinct(), "cid", "left_semi").select("text_key", "cid")
    sets = _sets(docs, text_col, wanted, width)

    def possible(x: str, y: str):
        return 100 * F.least(x, y) >= percent * F.greatest(x, y)

    star = (
        members.where((F.col("cid") != F.col("hub")) & possible("size", "hub_size"))
        .select(F.col("hub").alias("a"), F.col("cid").alias("b"))
        .distinct()
    )
    links = stored(_confirmed(star, sets, percent), "near-links")
    labels = components(links, "near-stars")
    # what is not yet joined, in buckets with more than one component
    labelled = members.join(labels.withColumnRenamed("node", "cid"), "cid", "left").select(
        "key", "cid", "size", F.coalesce("label", "cid").alias("label")
    )
    parts = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = stored(
        parts.groupBy("key")
        .agg(F.max(F.struct("n", "label")).alias("most"), F.count(F.lit(1)).alias("n_labels"), F.sum("n").alias("members"))
        .where(F.col("n_labels") > 1)
        .select("key", F.col("most.label").alias("main"), "members"),
        "near-mixed",
    )
    left = stored(labelled.join(mixed, "key"), "near-left")
    small = left.where(F.col("members") < large_bucket)
    minor = small.where(F.col("label") != F.col("main")).select("key", F.col("cid").alias("c1"), F.col("size").alias("s1"), F.col("label").alias("l1"))
    rest = (
        minor.join(small, "key")
        .where((F.col("label") != F.col("l1")) & possible("size", "s1"))
        .select(F.least("cid", "c1").alias("a"), F.greatest("cid", "c1").alias("b"))
        .distinct()
    )
    crowded = left.where(F.col("members") >= large_bucket).select(F.col("main").alias("family"), "cid", "label").distinct()
    more = stored(_confirmed(rest, sets, percent).unionByName(_searched(crowded, sets, percent)), "near-rest")
    joined = components(links.unionByName(more), "near-components")
    named = (
        classes.select("set_key", "min_id", "cid")
        .join(joined.withColumnRenamed("node", "cid"), "cid", "left")
        .select("set_key", "min_id", F.coalesce("label", "cid").alias("label"))
    )
    smallest = stored(named.groupBy("label").agg(F.min("min_id").alias("component")), "near-smallest")
    by_set = named.join(smallest, "label").select("set_key", "component")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return (
        base.drop("bands")
        .join(by_set, "set_key", "left")
        .select("doc_id", "text_key", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows, all columns, of one document from each component. Of rows with the same id and text one stays.

    Empty texts are linked with nothing and all stay, apart from such repeated rows.
    """
    found = near_duplicates(docs, id_col, text_col, **options)
    keep = found.where("kept").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_key"), "text_key").distinct()
    keyed = docs.select(
        F.struct("*").alias("row"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc_key"), F.unhex(F.md5(text_bytes(docs, text_col))).alias("text_key")
    )
    return keyed.join(keep, ["doc_key", "text_key"], "left_semi").dropDuplicates(["doc_key", "text_key"]).select("row.*")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_shingles", "component_id", "kept")


SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT rid, unnest(CASE WHEN len(w) > 1 THEN [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] ELSE w END) AS g
  FROM d),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
pairs AS (SELECT x.rid AS a, y.rid AS b, count(*) AS shared FROM s x JOIN s y ON x.g = y.g AND x.rid < y.rid GROUP BY ALL),
l AS (
  SELECT a, b FROM pairs JOIN n p ON p.rid = a JOIN n q ON q.rid = b WHERE 100 * shared >= 80 * (p.n + q.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT rid, rid AS other FROM d UNION SELECT r.rid, e.b FROM r JOIN e ON e.a = r.other),
c AS (SELECT r.rid, min(o.doc_id) AS component_id FROM r JOIN d o ON o.rid = r.other GROUP BY r.rid)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN c USING (rid) LEFT JOIN n USING (rid)
"""
