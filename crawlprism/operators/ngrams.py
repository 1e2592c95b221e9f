"""Term and n-gram frequencies.

Counting works on numbers: the tokens of a piece of an Arrow batch become codes of the piece's own dictionary, windows of codes are
counted per piece, and only the distinct ones are spelled out. What is shuffled is one row for each distinct n-gram of a task.

Reports of the most frequent n-grams need fewer still. An n-gram is at most as frequent as its rarest word, so once a lower
bound for the last place of the report is known, windows with a rarer word are never counted. One pass gives the frequencies of all words and,
of n-grams, the exact counts of one slice of them by hash; the last place within that slice is such a bound. The
second pass counts what is left. The frequencies travel to the second pass as a table of fixed size: for each hash bucket, whether any
of its words reaches the bound. Words that share a bucket with a frequent one are counted needlessly, and no n-gram is missed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlprism.functions import text as X
from crawlprism.operators import dictionaries as D
from crawlprism.operators.sampling import first_per_group
from crawlprism.session import cut_lineage

# Hash buckets of the word frequencies, which bounds what is sent to each task (one bit each).
BUCKETS = 2**20
# One n-gram in so many belongs to the slice that the first pass counts.
SLICES = 16
# Tokens that are counted at once, whatever an Arrow batch holds: some hundred bytes of arrays and spelled n-grams for each.
PIECE_TOKENS = 2**18


def terms(
    df: DataFrame,
    text_col: str = "text_norm",
    ngram_range: tuple[int, int] = (1, 1),
    stop_words: Iterable[str] = D.ENGLISH_STOP_WORDS,
    additional_stop_words: Iterable[str] = (),
    keep: Iterable[str] = (),
) -> DataFrame:
    """One row per n-gram occurrence. Stop words go before n-grams form, so n-grams span them.

    Unigrams are exploded from the expression itself: for a plain column the optimizer adds
    a non-empty test, which it pushes down to a second tokenisation.
    """
    low, high = _range(ngram_range)
    removed = [*stop_words, *additional_stop_words]
    words = X.without_words(X.term_tokens(text_col), removed)
    if high == 1:
        return df.select(*keep, F.explode(words).alias("term"))
    tokens = df.select(*keep, words.alias("_tokens"))
    grams = [X.ngrams(F.col("_tokens"), n) for n in range(low, high + 1)]
    every = grams[0] if len(grams) == 1 else F.concat(*grams)
    return tokens.select(*keep, F.explode(every).alias("term"))


def _range(ngram_range: tuple[int, int]) -> tuple[int, int]:
    low, high = ngram_range
    if not 1 <= low <= high:
        raise ValueError("ngram_range must be (low, high) with 1 <= low <= high")
    return low, high


def _windows(codes: np.ndarray, rows: np.ndarray, wanted: np.ndarray, n: int) -> np.ndarray:
    """First places of the windows of ``n`` wanted tokens within one row."""
    last = len(codes) - n + 1
    if last <= 0:
        return np.zeros(0, np.int64)
    fits = rows[:last] == rows[n - 1 :]
    allowed = wanted[codes]
    for k in range(n):
        fits &= allowed[k : k + last]
    return np.flatnonzero(fits)


def _distinct(parts: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Of rows of numbers, given as (column, size of its range): the first place and the count of each distinct row."""
    key, span = parts[0][0].astype(np.int64), parts[0][1]
    for column, size in parts[1:]:
        if span * size >= 2**62:
            _, key = np.unique(key, return_inverse=True)
            span = len(key)
        key, span = key * size + column, span * size
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    return first, counts


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of whole rows of at most PIECE_TOKENS tokens; a longer row is one run."""
    lengths = pc.fill_null(pc.list_value_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(lengths, dtype=np.int64), 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + PIECE_TOKENS, side="right")))
        yield batch.slice(at, end - at)
        at = end


def _batch_counts(batch: pa.RecordBatch, sizes: Iterable[int], removed: pa.Array, frequent: np.ndarray | None, sliced: int) -> Iterator[pa.RecordBatch]:
    """Rows (group columns, n, term, frequency) of one batch, whose last column holds the tokens."""
    tokens, groups = batch.column(batch.num_columns - 1), batch.columns[:-1]
    names = batch.schema.names[:-1]
    rows = np.repeat(np.arange(len(tokens)), pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False))
    coded = tokens.flatten().dictionary_encode()
    words, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    kept = ~pc.is_in(words, removed).to_numpy(zero_copy_only=False) if len(words) else np.zeros(0, bool)
    codes, rows = codes[kept[codes]], rows[kept[codes]]
    hashes = np.fromiter((zlib.crc32(w.encode()) for w in words.to_pylist()), np.int64, len(words)) if frequent is not None or sliced > 1 else None
    wanted = np.ones(len(words), bool) if frequent is None else (frequent[(hashes % BUCKETS) >> 3] >> ((hashes % BUCKETS) & 7)) & 1 == 1
    group_codes = [g.dictionary_encode(null_encoding="encode") for g in groups]
    group_parts = [(g.indices.to_numpy(zero_copy_only=False), max(1, len(g.dictionary))) for g in group_codes]
    for n in sizes:
        at = _windows(codes, rows, wanted, n)
        if n > 1 and sliced > 1 and len(at):
            mixed = hashes[codes[at]]
            for k in range(1, n):
                mixed = (mixed * 1_000_003 + hashes[codes[at + k]]) % (2**31 - 1)
            at = at[mixed % sliced == 0]
        if not len(at):
            continue
        parts = [(column[rows[at]], size) for column, size in group_parts] + [(codes[at + k], len(words)) for k in range(n)]
        first, counts = _distinct(parts)
        at = at[first]
        spelled = pc.binary_join_element_wise(*(pc.array_take(words, pa.array(codes[at + k])) for k in range(n)), " ")
        of = pa.array(rows[at])
        yield pa.RecordBatch.from_arrays(
            [*(pc.array_take(g, of) for g in groups), pa.array(np.full(len(at), n, np.int32)), spelled, pa.array(counts.astype(np.int64))],
            [*names, "n", "term", "frequency"],
        )


def _counts(df: DataFrame, text_col: str, group: list[str], sizes: Iterable[int], removed: Iterable[str], frequent: bytes | None = None, sliced: int = 1) -> DataFrame:
    """(group, n, term, frequency); pieces of batches count first, then tasks, then the shuffle."""
    sizes, removed = list(sizes), sorted({w.lower() for w in removed})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stop = pa.array(removed, pa.string())
        table = None if frequent is None else np.frombuffer(frequent, np.uint8)
        for batch in batches:
            for piece in _pieces(batch):
                yield from _batch_counts(piece, sizes, stop, table, sliced)
        pa.default_memory_pool().release_unused()

    kinds = "".join(f"`{name}` {df.schema[name].dataType.simpleString()}, " for name in group)
    partial = df.select(*group, X.term_tokens(text_col).alias("_tokens")).mapInArrow(run, f"{kinds}n int, term string, frequency bigint")
    return partial.groupBy(*group, "n", "term").agg(F.sum("frequency").alias("frequency"))


def term_counts(
    df: DataFrame,
    text_col: str = "text_norm",
    group: Iterable[str] = (),
    ngram_range: tuple[int, int] = (1, 1),
    stop_words: Iterable[str] = D.ENGLISH_STOP_WORDS,
    additional_stop_words: Iterable[str] = (),
) -> DataFrame:
    """Corpus frequency of each n-gram, per group if given; counted before the shuffle."""
    low, high = _range(ngram_range)
    return _counts(df, text_col, list(group), range(low, high + 1), [*stop_words, *additional_stop_words]).drop("n")


def _last_place(counts: DataFrame, group: list[str], k: int) -> int:
    """A frequency that at least ``k`` n-grams of every group reach; 0 if a group has fewer."""
    if not group:
        top = counts.orderBy(F.desc("frequency")).limit(k).agg(F.count(F.lit(1)).alias("n"), F.min("frequency").alias("last")).first()
        return top["last"] if top["n"] == k else 0
    best = first_per_group(counts.where("counts"), group, [F.desc("frequency"), F.col("term")], k)
    per = counts.select(*group).distinct().join(
        best.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.min("frequency").alias("last")),
        [counts[g].eqNullSafe(best[g]) for g in group], "left",
    )
    return per.agg(F.min(F.when(F.col("n") == k, F.col("last")).otherwise(0))).first()[0] or 0


def _frequent(words: DataFrame, group: list[str], bound: int) -> bytes:
    """The buckets with a word that is at least ``bound`` times in the corpus, as bits. BUCKETS bounds what the driver gets."""
    totals = words.groupBy("term").agg(F.sum("frequency").alias("frequency")) if group else words
    bucket = F.crc32(F.col("term").cast("binary")) % BUCKETS
    reached = totals.where(F.col("frequency") >= bound).select(bucket.cast("int").alias("b")).distinct()
    bits = np.zeros(BUCKETS, np.uint8)
    bits[[r["b"] for r in reached.collect()]] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _pruned_counts(df: DataFrame, text_col: str, group: list[str], low: int, high: int, removed: list[str], k: int) -> DataFrame:
    """Counts that hold every n-gram of the top ``k`` of every group."""
    if high == 1:
        return _counts(df, text_col, group, [1], removed)
    # all words, and a slice of the longer n-grams unless words are in the report themselves
    first = cut_lineage(_counts(df, text_col, group, [1] if low == 1 else [1, *range(low, high + 1)], removed, sliced=SLICES))
    # every group has its words here, so a group without n-grams is seen too
    bound = _last_place(first.withColumn("counts", F.col("n") >= low) if group else first.where(F.col("n") >= low), group, k)
    words = first.where("n = 1")
    frequent = _frequent(words, group, bound) if bound > 1 else None
    longer = _counts(df, text_col, group, range(max(low, 2), high + 1), removed, frequent)
    return longer.unionByName(words) if low == 1 else longer


def top_ngrams(
    df: DataFrame,
    text_col: str = "text_norm",
    ngram_range: tuple[int, int] = (1, 1),
    additional_stop_words: Iterable[str] = (),
    top_n: int = 10,
    stop_words: Iterable[str] = D.ENGLISH_STOP_WORDS,
) -> DataFrame:
    low, high = _range(ngram_range)
    counts = _pruned_counts(df, text_col, [], low, high, [*stop_words, *additional_stop_words], top_n)
    return counts.select("term", "frequency").orderBy(F.desc("frequency"), "term").limit(top_n)


def top_ngrams_by(
    df: DataFrame,
    group_col: str = "label",
    text_col: str = "text_norm",
    top_n: int = 25,
    ngram_range: tuple[int, int] = (1, 1),
    stop_words: Iterable[str] = D.ENGLISH_STOP_WORDS,
    additional_stop_words: Iterable[str] = (),
) -> DataFrame:
    """Top n-grams of every group side by side."""
    low, high = _range(ngram_range)
    counts = _pruned_counts(df, text_col, [group_col], low, high, [*stop_words, *additional_stop_words], top_n)
    return first_per_group(counts.select(group_col, "term", "frequency"), [group_col], [F.desc("frequency"), F.col("term")], top_n)
