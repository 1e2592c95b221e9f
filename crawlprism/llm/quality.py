"""Quality rules: repetition coverage by rolling hashes of several n-gram lengths.

Each text's words become integer codes in numpy. Hashes of length n + 1 roll on from those of length n.
A word that lies in an n-gram that occurred before, and a line that occurred before, count with their
characters; the shares of the text decide. So do all places of the most frequent short n-gram.

Defined cases: null text has no words and fails the base rule, as does any text of under 50 words.
Repeated rows give repeated rows. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlprism.llm.common import map_batches, text_bytes

# Share of a text's characters above which it is dropped.
TOP_NGRAM = {2: 0.20, 3: 0.18, 4: 0.16}
DUPLICATED_NGRAM = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
DUPLICATED_LINES = 0.20

# The base rule.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
REPEAT_WINDOW = 3

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_CONTINUATION = bytes(range(0x80, 0xC0))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def code_points(data: bytes) -> int:
    return len(data) if data.isascii() else len(data.translate(None, _CONTINUATION))


def _mixed(codes: np.ndarray) -> np.ndarray:
    x = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def _covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Words inside any window that begins at a marked start."""
    edge = np.zeros(n + 1, np.int32)
    edge[: len(starts)] += starts
    edge[length : length + len(starts)] -= starts
    return np.cumsum(edge[:n]) > 0


def _counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position how often its key occurs, and whether it occurred before."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    sizes = np.diff(np.append(first, len(ranked)))
    out = np.empty(len(keys), np.int64)
    out[order] = np.repeat(sizes, sizes)
    again = np.ones(len(keys), bool)
    again[order[first]] = False
    return out, again


def measure(text: bytes) -> dict:
    """The base counts and the repetition shares of one text."""
    words = text.split()
    n = len(words)
    row = {
        "n_words": n,
        "word_chars": code_points(text.translate(None, SPACES)),
        "n_symbols": len(text) - len(text.translate(None, SYMBOLS)),
        "n_dup_lines": 0,
        "n_repeat_words": 0,
        "dup_line_share": 0.0,
        "top_ngram_share": 0.0,
        "dup_ngram_share": 0.0,
        "repetitive": False,
    }
    if not n:
        return row
    total = row["word_chars"]
    seen: set[bytes] = set()
    dup_chars = 0
    for line in text.split(b"\n"):
        if line in seen:
            row["n_dup_lines"] += 1
            dup_chars += code_points(line.translate(None, SPACES))
        elif line.strip(SPACES):
            seen.add(line)
    row["dup_line_share"] = dup_chars / total
    code: dict[bytes, int] = {}
    codes = np.fromiter([code.setdefault(w, len(code)) for w in words], np.int64, n)
    sizes = np.fromiter([code_points(w) for w in code], np.int64, len(code))[codes]
    over = row["dup_line_share"] > DUPLICATED_LINES
    mixed = _mixed(codes)
    rolled = mixed
    for length in range(2, max(DUPLICATED_NGRAM) + 1):
        if n < length:
            break
        rolled = rolled[: n - length + 1] * _BASE + mixed[length - 1 :]
        if length == REPEAT_WINDOW:
            # the base rule is exact: no hash, but a number that stands for the three codes
            k = len(code)
            if k**3 < 2**62:
                keys = (codes[:-2] * k + codes[1:-1]) * k + codes[2:]
            else:
                keys = np.unique(np.stack([codes[:-2], codes[1:-1], codes[2:]]), axis=1, return_inverse=True)[1].ravel()
        else:
            keys = rolled
        counts, again = _counts(keys)
        repeated = counts > 1
        if length == REPEAT_WINDOW:
            row["n_repeat_words"] = int(_covered(repeated, length, n).sum())
        if length in TOP_NGRAM and repeated.any():
            # of equally frequent n-grams the one that comes first
            top = keys == keys[np.argmax(counts)]
            share = float(sizes[_covered(top, length, n)].sum() / total)
            row["top_ngram_share"] = max(row["top_ngram_share"], share)
            over |= share > TOP_NGRAM[length]
        if length in DUPLICATED_NGRAM:
            if not repeated.any():
                break  # a longer n-gram cannot be duplicated either
            share = float(sizes[_covered(again, length, n)].sum() / total)
            row["dup_ngram_share"] = max(row["dup_ngram_share"], share)
            over |= share > DUPLICATED_NGRAM[length]
    row["repetitive"] = bool(over)
    return row


_FIELDS = {
    "n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(), "dup_line_share": pa.float64(), "top_ngram_share": pa.float64(),
    "dup_ngram_share": pa.float64(), "repetitive": pa.bool_(),
}


def repetition(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row: base counts, repetition shares, ``base_failed`` and ``kept``. No shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [measure(t) for t in batch.column(1).to_pylist()]
        columns = [pa.array([r[name] for r in rows], kind) for name, kind in _FIELDS.items()]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *_FIELDS])

    kind = docs.schema[id_col].dataType.simpleString()
    measured = map_batches(
        docs.select(F.col(id_col).alias("doc_id"), text_bytes(docs, text_col).alias("text")),
        run,
        f"doc_id {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
        "dup_line_share double, top_ngram_share double, dup_ngram_share double, repetitive boolean",
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & ~F.col("repetitive"))


def digest(measured: DataFrame) -> DataFrame:
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _limits(values: dict[int, float]) -> str:
    return " OR ".join(f"(m = {n} AND share > {limit})" for n, limit in values.items())


_WORD_SQL = r"'[^\x20\x09-\x0D]+'"

SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORD_SQL}) AS w FROM documents),
word AS (SELECT rid, unnest(range(len(w))) AS p, length(unnest(w)) AS size FROM d),
total AS (SELECT rid, sum(size) AS chars FROM word GROUP BY rid),
line AS (SELECT rid, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM d),
again AS (
  SELECT rid, line FROM line WHERE regexp_matches(line, {_WORD_SQL})
  QUALIFY row_number() OVER (PARTITION BY rid, line ORDER BY pos) > 1),
lines AS (
  SELECT rid, count(*) AS n_dup_lines, sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) AS dup_chars FROM again GROUP BY rid),
gram AS (
  SELECT rid, m, i, array_to_string(w[i + 1:i + m], ' ') AS g
  FROM (SELECT rid, w, m, unnest(range(len(w) - m + 1)) AS i FROM d, (SELECT unnest(range(2, 11)) AS m) WHERE len(w) >= m)),
counted AS (
  SELECT rid, m, i, g, count(*) OVER (PARTITION BY rid, m, g) AS n, row_number() OVER (PARTITION BY rid, m, g ORDER BY i) AS nth FROM gram),
repeated AS (SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM counted WHERE m = {REPEAT_WINDOW} AND n > 1) GROUP BY rid),
top AS (
  SELECT rid, m, g FROM counted WHERE m IN ({", ".join(map(str, TOP_NGRAM))}) AND n > 1
  QUALIFY row_number() OVER (PARTITION BY rid, m ORDER BY n DESC, i) = 1),
place AS (
  SELECT DISTINCT rid, m, p, is_top FROM (
    SELECT rid, m, unnest(range(i, i + m)) AS p, true AS is_top FROM counted JOIN top USING (rid, m, g)
    UNION ALL
    SELECT rid, m, unnest(range(i, i + m)), false FROM counted WHERE m IN ({", ".join(map(str, DUPLICATED_NGRAM))}) AND nth > 1)),
shares AS (SELECT rid, m, is_top, sum(size) / any_value(chars) AS share FROM place JOIN word USING (rid, p) JOIN total USING (rid) GROUP BY ALL),
over AS (
  SELECT DISTINCT rid FROM shares WHERE (is_top AND ({_limits(TOP_NGRAM)})) OR (NOT is_top AND ({_limits(DUPLICATED_NGRAM)}))
  UNION SELECT rid FROM lines JOIN total USING (rid) WHERE dup_chars / chars > {DUPLICATED_LINES}),
base AS (
  SELECT rid, doc_id, len(w)::BIGINT AS n_words, coalesce(chars, 0)::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN total USING (rid) LEFT JOIN lines USING (rid) LEFT JOIN repeated USING (rid))
SELECT * EXCLUDE (rid), n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words) AND rid NOT IN (SELECT rid FROM over) AS kept
FROM base
"""
