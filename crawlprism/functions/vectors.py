"""Dot products over array columns and sparse ML vectors in the JVM, and over token lists in Arrow batches."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def dense_dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def dense_cosine(a: Column, b: Column) -> Column:
    """NULL when either vector has zero norm."""
    norms = F.sqrt(dense_dot(a, a)) * F.sqrt(dense_dot(b, b))
    return F.when(norms > 0, dense_dot(a, b) / norms)


def sparse_parts(vector: Column) -> Column:
    """``struct(type, size, indices, values)`` behind an ML vector column."""
    return F.unwrap_udt(vector)


def sparse_dot_dense(parts: Column, dense: Column) -> Column:
    """Dot of a sparse vector with a dense array addressed by position."""
    return _sum(
        F.zip_with(parts["indices"], parts["values"], lambda i, v: v * F.get(dense, i))
    )


def sparse_norm(parts: Column) -> Column:
    return F.sqrt(_sum(F.transform(parts["values"], lambda v: v * v)))


def term_norms_and_dots(lists: pa.Array, weights: Mapping[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """For each token list its squared norm and its dot product with the term counts of another list.

    The tokens become codes of the array's dictionary, so the other list's weights are looked up once for
    each distinct term and all sums are over numbers. A null list counts as empty.
    """
    n = len(lists)
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    coded = lists.flatten().dictionary_encode()
    size = max(1, len(coded.dictionary))
    key = np.repeat(np.arange(n, dtype=np.int64), lengths) * size + coded.indices.to_numpy(zero_copy_only=False)
    pairs, counts = np.unique(key, return_counts=True)
    norm2, dot = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if len(pairs):
        # a term that the other list lacks takes the zero at the end
        at = pc.fill_null(pc.index_in(coded.dictionary, pa.array(list(weights), pa.string())), len(weights))
        values = np.array([*weights.values(), 0], np.int64)[at.to_numpy(zero_copy_only=False)]
        np.add.at(norm2, pairs // size, counts * counts)
        np.add.at(dot, pairs // size, counts * values[pairs % size])
    return norm2, dot


def squared_term_norm(tokens: Column) -> Column:
    """Sum of squared term counts of one token list.

    Equal tokens are adjacent after a sort; the n-th copy of a term adds
    n^2 - (n-1)^2 = 2n - 1.
    """
    start = F.struct(
        F.lit(None).cast("string").alias("term"), F.lit(0).cast("bigint").alias("run"), F.lit(0).cast("bigint").alias("total")
    )

    def step(acc: Column, token: Column) -> Column:
        run = F.when(acc["term"].eqNullSafe(token), acc["run"] + 1).otherwise(F.lit(1).cast("bigint"))
        return F.struct(token.alias("term"), run.alias("run"), (acc["total"] + 2 * run - 1).alias("total"))

    return F.aggregate(F.sort_array(tokens), start, step, lambda acc: acc["total"])
