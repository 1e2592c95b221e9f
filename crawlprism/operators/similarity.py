"""Similarity of every page to one anchor page."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlprism.functions import vectors as V
from crawlprism.operators.sampling import first_per_group


def one_page_per_uri(
    df: DataFrame,
    uri_col: str = "target_uri",
    text_col: str = "text_norm",
    tiebreak: str = "record_id",
    keep: list[str] | None = None,
) -> DataFrame:
    """The longest version of each page.

    Only each task's best row per URI is shuffled, so a URI with very many copies
    costs no more than one row per task. ``keep`` names the columns wanted beside the URI and
    the tiebreak: the text is then measured where it is and not shuffled. ``length(text)`` is
    given as ``n_text``.
    """
    ranked = df.withColumn("n_text", F.length(text_col))
    if keep is not None:
        ranked = ranked.select(*dict.fromkeys([uri_col, tiebreak, *keep]), "n_text")
    best = first_per_group(ranked, [uri_col], [F.desc("n_text"), F.col(tiebreak)])
    return best if keep is not None else best.drop("n_text")


def find_anchor(df: DataFrame, uri: str, uri_col: str = "target_uri") -> DataFrame:
    """The anchor's row; an error when the URI is absent."""
    anchor = df.where(F.col(uri_col) == uri).limit(1)
    if anchor.isEmpty():
        raise ValueError(f"no page with URI {uri!r}")
    return anchor


def anchor_host(uri: str) -> str:
    from urllib.parse import urlparse

    return urlparse(uri).netloc


def without_host(df: DataFrame, host: str | Column, uri_col: str = "target_uri") -> DataFrame:
    return df.where(~F.col(uri_col).contains(host))


def with_dense_cosine(
    df: DataFrame, anchor: DataFrame, vector_col: str = "embedding", out_col: str = "cosine_to_anchor"
) -> DataFrame:
    """Cosine of each array vector with the anchor's. ``anchor`` has one row; its vector is a scalar subquery."""
    one = anchor.select(vector_col).scalar()
    return (
        df.withColumn("_anchor", one)
        .withColumn(out_col, V.dense_cosine(F.col(vector_col), F.col("_anchor")))
        .drop("_anchor")
    )


def with_hashed_cosine(
    df: DataFrame, anchor: DataFrame, num_features: int, vector_col: str = "tf_raw", out_col: str = "cosine_to_anchor"
) -> DataFrame:
    """Cosine of sparse ML vectors with the anchor's, map-only and in the JVM.

    The anchor becomes one dense array (``num_features`` bounds it), so each non-zero
    entry of a page is looked up by position.
    """
    a = F.unwrap_udt(vector_col)
    dense = F.transform(
        F.sequence(F.lit(0), F.lit(num_features - 1)),
        lambda i: F.coalesce(
            F.get(a["values"], (F.array_position(a["indices"], i) - 1).cast("int")), F.lit(0.0)
        ),
    )
    one = anchor.select(F.when(F.size(a["indices"]) > 0, dense).otherwise(F.array(F.lit(0.0))).alias("v"))
    parts = F.col("_parts")
    norms = V.sparse_norm(parts) * F.sqrt(F.aggregate("_anchor", F.lit(0.0), lambda s, v: s + v * v))
    return (
        df.withColumns({"_anchor": one.scalar(), "_parts": V.sparse_parts(F.col(vector_col))})
        .withColumn("_norms", norms)
        .withColumn(
            out_col,
            F.when(F.col("_norms") > 0, V.sparse_dot_dense(parts, F.col("_anchor")) / F.col("_norms")),
        )
        .drop("_anchor", "_parts", "_norms")
    )


def term_cosine(df: DataFrame, anchor: DataFrame, id_col: str, tokens_col: str = "tokens") -> DataFrame:
    """(id, cosine) over raw term counts for every row, zero when no term is shared.

    A row's norm and dot product come from its own tokens, so rows are neither exploded nor shuffled, and
    rows that share an id stay apart. See ``with_term_cosine`` for the anchor.
    """
    return with_term_cosine(df.select(id_col, tokens_col), anchor, tokens_col).select(id_col, "cosine_to_anchor")


def with_term_cosine(
    df: DataFrame, anchor: DataFrame, tokens_col: str = "tokens", out_col: str = "cosine_to_anchor"
) -> DataFrame:
    """Adds the cosine of ``term_cosine``.

    ``anchor`` has one row. Its distinct terms with their counts are read at once and travel with the tasks: one page's
    vocabulary, whatever the size of the corpus. NULL where either side has no tokens. All columns of ``df`` pass
    through Arrow batches, so give it those that are wanted.
    """
    counts = anchor.limit(1).select(F.explode(tokens_col).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    weights = {r["term"]: r["n"] for r in counts.collect()}
    place = df.columns.index(tokens_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norm2, dot = V.term_norms_and_dots(batch.column(place), weights)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(norm2), pa.array(dot)], [*batch.schema.names, "_norm2", "_dot"])

    parts = T.StructType([*df.schema.fields, T.StructField("_norm2", T.LongType()), T.StructField("_dot", T.LongType())])
    norms = F.sqrt(F.col("_norm2").cast("double")) * F.lit(float(sum(n * n for n in weights.values())) ** 0.5)
    return df.mapInArrow(run, parts).withColumn(out_col, F.when(norms > 0, F.col("_dot") / norms)).drop("_norm2", "_dot")


def most_similar(df: DataFrame, k: int = 20, score_col: str = "cosine_to_anchor", tiebreak: str = "record_id") -> DataFrame:
    return df.orderBy(F.desc(score_col), tiebreak).limit(k)


__all__ = [
    "anchor_host",
    "find_anchor",
    "most_similar",
    "one_page_per_uri",
    "term_cosine",
    "with_dense_cosine",
    "with_hashed_cosine",
    "with_term_cosine",
    "without_host",
]
