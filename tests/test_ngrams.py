"""N-gram counts on codes against one row per occurrence, and what the pruning leaves to shuffle."""

import random

import pytest
from pyspark.sql import functions as F

from crawlprism.operators import ngrams


@pytest.fixture(scope="module")
def pages(spark):
    pick = random.Random(8)
    words = [f"w{i}" for i in range(400)] + ["é́x", "ÀB", "a_b", "x1"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = [(i, " ".join(pick.choices(words, weights, k=pick.randrange(0, 60))), pick.choice(["cites", "repackages", None])) for i in range(300)]
    rows += [(1000, None, "cites"), (1001, "", None), (1002, "w1 w2 w3", "rare")]
    return spark.createDataFrame(rows, "id int, t string, label string").repartition(5).cache()


def plain(df, group, ngram_range, stop):
    occurrences = ngrams.terms(df, "t", ngram_range, stop_words=stop, keep=group)
    return occurrences.groupBy(*group, "term").agg(F.count(F.lit(1)).alias("frequency"))


@pytest.mark.parametrize("ngram_range", [(1, 1), (2, 2), (1, 3), (3, 4)])
def test_counts_are_those_of_the_occurrences(pages, ngram_range):
    for group in ([], ["label"]):
        got = ngrams.term_counts(pages, "t", group, ngram_range, stop_words=["w0", "W5"])
        want = plain(pages, group, ngram_range, ["w0", "W5"])
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


@pytest.mark.parametrize("ngram_range", [(2, 2), (1, 3), (2, 3)])
@pytest.mark.parametrize("k", [1, 7, 10_000])
def test_pruned_reports_are_whole(pages, ngram_range, k):
    got = ngrams.top_ngrams(pages, "t", ngram_range, top_n=k, stop_words=[])
    want = plain(pages, [], ngram_range, []).orderBy(F.desc("frequency"), "term").limit(k)
    assert list(map(tuple, got.collect())) == list(map(tuple, want.collect()))


def test_pruned_reports_by_group(pages):
    for k in (3, 50):
        got = ngrams.top_ngrams_by(pages, "label", "t", k, (2, 2), stop_words=[])
        best = {}
        for label, term, n in sorted(map(tuple, plain(pages, ["label"], (2, 2), []).collect()), key=lambda r: (-r[2], r[1])):
            best.setdefault(label, []).append((term, n))
        want = [(label, *row) for label, rows in best.items() for row in rows[:k]]
        assert sorted(map(tuple, got.select("label", "term", "frequency").collect()), key=str) == sorted(want, key=str)


def test_rare_words_are_not_shuffled(spark):
    """Pages of rare words that share a passage: only the passage's words reach the bound."""
    pick = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(200))
    rows = [(" ".join(f"r{pick.randrange(3_000)}" for _ in range(100)) + " " + (passage if i % 2 else ""),) for i in range(100)]
    df = spark.createDataFrame(rows, "t string")
    every = ngrams._counts(df, "t", [], [2, 3], []).count()
    left = ngrams._pruned_counts(df, "t", [], 2, 3, [], 5)
    assert every > 10_000 and left.count() == 199 + 198
    top = ngrams.top_ngrams(df, "t", (2, 3), top_n=5, stop_words=[]).collect()
    assert [tuple(r) for r in top] == sorted([(f"p{i} p{i + 1}", 50) for i in range(199)] + [(f"p{i} p{i + 1} p{i + 2}", 50) for i in range(198)])[:5]


def test_wide_keys_are_made_dense():
    import numpy as np

    pick = np.random.default_rng(2)
    columns = [pick.integers(0, 5, 1_000) for _ in range(4)]
    first, counts = ngrams._distinct([(c, 2**40) for c in columns])
    rows = list(zip(*[c.tolist() for c in columns]))
    assert {rows[i]: n for i, n in zip(first, counts)} == {r: rows.count(r) for r in set(rows)}


def test_a_batch_is_counted_in_pieces(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(ngrams, "PIECE_TOKENS", 10)
    pick = random.Random(4)
    lists = [None, [], ["a"] * 25, *([pick.choice("abc") for _ in range(pick.randrange(9))] for _ in range(40)), [], None]
    whole = pa.RecordBatch.from_arrays([pa.array(["x", None, "y"] * 15), pa.array(lists, pa.list_(pa.string()))], ["label", "_tokens"])
    batch = whole.slice(1)

    def added(parts):
        total = {}
        for part in parts:
            for row in (r for b in ngrams._batch_counts(part, [1, 3], pa.array(["c"]), None, 1) for r in b.to_pylist()):
                key = (row["label"], row["n"], row["term"])
                total[key] = total.get(key, 0) + row["frequency"]
        return total

    pieces = list(ngrams._pieces(batch))
    assert pa.Table.from_batches(pieces).to_pylist() == batch.to_pylist()
    sizes = [[len(r or []) for r in p.column(1).to_pylist()] for p in pieces]
    assert len(pieces) > 5 and all(sum(s) <= 10 or len(s) == 1 for s in sizes)
    assert added(pieces) == added([batch])
    assert list(ngrams._pieces(batch.slice(0, 0))) == []
