"""Awkward tables and plain versions of the operators' contracts."""

from __future__ import annotations

import random

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"


def rows(name: str, sf: str = SF) -> list[dict]:
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


def prose(seed: int, n: int, vocabulary: int = 4000) -> str:
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary):x}é" if pick.random() < 0.1 else f"w{pick.randrange(vocabulary):x}" for _ in range(n))


LONG = prose(1, 30_000)
BASE = prose(2, 300)
PASSAGE = prose(3, 40)

# id, text: nulls, empty, white space, repeated rows, ties, near copies, one long text
AWKWARD: list[tuple[int | None, str | None]] = [
    (10, None),
    (11, ""),
    (12, " \n\t "),
    (13, "!!! ... 123"),
    (14, "one"),
    (15, "one"),
    (16, BASE),
    (17, BASE),
    (17, BASE),
    (None, BASE),
    (None, None),
    (5, BASE + " and a tail of five words"),
    (18, prose(4, 60) + " " + PASSAGE + " " + prose(5, 60)),
    (19, prose(6, 60) + " " + PASSAGE + " " + prose(7, 60)),
    (20, LONG),
    (21, "x\u0085y z 中文 \U0001f600 'S it's don't  two  spaces\n\n\nlines <|endoftext|>"),
    (22, "a" * 3000),
    (23, "ab" * 25),
    (24, "ab" * 25),
    (25, "tail"),
]

CLASHING = ["text_key", "doc_key", "row", "spans", "kept", "component_id", "bands", "block", "bucket", "payload", "ids", "h", "label", "clean"]


def awkward(spark, texts=None):
    """The awkward rows as documents with further columns whose names the operators use themselves."""
    data = [(i, t, None if k % 3 else "xx", f"s{k}", k) for k, (i, t) in enumerate(AWKWARD if texts is None else texts)]
    df = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
    for name in CLASHING:
        df = df.selectExpr("*", f"concat('{name}-', source) as {name}")
    return df


def key(row):
    return tuple((v is not None, v) if not isinstance(v, list) else tuple(v) for v in row)


def same(got, want) -> None:
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)
