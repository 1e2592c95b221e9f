"""Class weights, splits, metrics, similarity and classifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlprism.functions import text as X
from crawlprism.functions.urls import authority
from crawlprism.operators import classify, features, metrics, sampling, signals, similarity
from crawlprism.plans import modelling
from crawlprism.registry.base import registry
from crawlprism.registry.fixtures import (
    CORPUS_SQL,
    SALTED_SQL,
    corpus,
    labelled_sql,
    load,
    salted,

)
from crawlprism.registry.text_queries import STOP
from crawlprism.session import cut_lineage

SALTED_LABELS = f"WITH {SALTED_SQL}, {labelled_sql('salted', 'doc_id')}"
CORPUS_LABELS = f"WITH {CORPUS_SQL}, {labelled_sql('corpus', 'record_id, target_uri')}"
COUNTS = "counts AS (SELECT label, count(*) AS n FROM labelled WHERE label IS NOT NULL GROUP BY label)"


def _labelled(spark, sf):
    return signals.label_pages(salted(spark, sf))


# --- classes and splits ---------------------------------------------------------------------


@registry.add(
    "label_index",
    f"""{SALTED_LABELS}, {COUNTS} SELECT label,
          CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS INT) AS label_idx FROM counts""",
)
def _(spark, sf):
    return features.label_index(_labelled(spark, sf))


@registry.add(
    "class_weights",
    f"""{SALTED_LABELS}, {COUNTS} SELECT label, round((SELECT max(n) FROM counts) / n, 6) AS class_weight FROM counts""",
)
def _(spark, sf):
    weights = features.class_weights(_labelled(spark, sf))
    return weights.withColumn("class_weight", F.round("class_weight", 6))


@registry.add(
    "class_weight_rows",
    f"""{SALTED_LABELS}, {COUNTS} SELECT doc_id, label, round((SELECT max(n) FROM counts) / n, 6) AS class_weight
        FROM labelled JOIN counts USING (label)""",
)
def _(spark, sf):
    rows = features.with_class_weight(cut_lineage(_labelled(spark, sf).select("doc_id", "label")))
    return rows.select("doc_id", "label", F.round("class_weight", 6).alias("class_weight"))


@registry.add(
    "hash_split",
    """SELECT doc_id, CASE WHEN CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80
         THEN 'train' ELSE 'test' END AS side FROM documents""",
)
def _(spark, sf):
    train, test = sampling.split_by_key(load(spark, sf, "documents", "doc_id"), "doc_id")
    return train.withColumn("side", F.lit("train")).unionAll(test.withColumn("side", F.lit("test")))


# --- metrics ------------------------------------------------------------------------------------

PREDICTED = """WITH predicted AS (
  SELECT quality AS label, CAST(n_chars > 2000 AS INT) AS prediction, CAST(n_chars AS DOUBLE) AS score
  FROM documents JOIN labels USING (doc_id))"""


def _predicted(spark, sf):
    docs = load(spark, sf, "documents", "doc_id", "n_chars")
    return docs.join(load(spark, sf, "labels", "doc_id", "quality"), "doc_id").select(
        F.col("quality").alias("label"),
        (F.col("n_chars") > 2000).cast("int").alias("prediction"),
        F.col("n_chars").cast("double").alias("score"),
    )


@registry.add("confusion", f"{PREDICTED} SELECT label, prediction, count(*) AS n FROM predicted GROUP BY ALL")
def _(spark, sf):
    return metrics.confusion(_predicted(spark, sf))


@registry.add(
    "precision_recall",
    f"""{PREDICTED}, c AS (SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
          count(*) FILTER (WHERE label <> 1 AND prediction = 1) AS fp,
          count(*) FILTER (WHERE label = 1 AND prediction <> 1) AS fn,
          count(*) FILTER (WHERE label <> 1 AND prediction <> 1) AS tn FROM predicted)
        SELECT tp, fp, fn, tn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall FROM c""",
)
def _(spark, sf):
    one = metrics.precision_recall(_predicted(spark, sf), 1)
    return one.withColumns({c: F.round(c, 6) for c in ("precision", "recall")})


@registry.add(
    "auc_rank",
    f"""{PREDICTED}, ranked AS (
          SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS r FROM predicted)
        SELECT round((sum(r) FILTER (WHERE label = 1)
               - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2)
               / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0)), 6) AS auc FROM ranked""",
)
def _(spark, sf):
    auc = metrics.area_under_roc(_predicted(spark, sf), "score", F.col("label") == 1)
    return auc.select(F.round("auc", 6).alias("auc"))


@registry.add(
    "f1_weighted",
    f"""{PREDICTED}, per AS (
          SELECT c, count(*) FILTER (WHERE label = c) AS real, count(*) FILTER (WHERE prediction = c) AS said,
                 count(*) FILTER (WHERE label = c AND prediction = c) AS hit
          FROM predicted, (SELECT unnest([0, 1]) AS c) GROUP BY c)
        SELECT round(sum(real * 2.0::DOUBLE * hit / (real + said)) / sum(real), 6) AS f1 FROM per""",
)
def _(spark, sf):
    return metrics.weighted_f1(_predicted(spark, sf)).select(F.round("f1", 6).alias("f1"))


# --- similarity -------------------------------------------------------------------------------------


@registry.add(
    "longest_per_uri",
    f"""{CORPUS_LABELS} SELECT record_id, target_uri, length(text_norm) AS n FROM norm
        QUALIFY row_number() OVER (PARTITION BY target_uri ORDER BY length(text_norm) DESC, record_id) = 1""",
)
def _(spark, sf):
    pages = corpus(spark, sf).withColumn("text_norm", X.normalize_text("content"))
    return similarity.one_page_per_uri(pages, keep=[]).select(
        "record_id", "target_uri", F.col("n_text").cast("bigint").alias("n")
    )


@registry.add(
    "cosine_embeddings",
    """SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[],
         (SELECT embedding FROM embeddings WHERE vec_id = 0)::DOUBLE[]), 6) AS cosine_to_anchor FROM embeddings""",
)
def _(spark, sf):
    vectors = load(spark, sf, "embeddings", "vec_id", "embedding")
    scored = similarity.with_dense_cosine(vectors, vectors.where(F.col("vec_id") == 0))
    return scored.select("vec_id", F.round("cosine_to_anchor", 6).alias("cosine_to_anchor"))


TERMS_SQL = """list_filter(regexp_split_to_array(lower({0}), '[^A-Za-z0-9_]'), lambda t: t <> '')"""


def _cosine_sql(source: str, key: str, text: str, anchor: str) -> str:
    words = f"list_filter({TERMS_SQL.format(text)}, lambda t: t NOT IN {STOP})"
    return f"""tf AS (
  SELECT {key}, term, count(*) AS n FROM (SELECT {key}, unnest({words}) AS term FROM {source}) GROUP BY ALL),
norms AS (SELECT {key}, sqrt(sum(n * n)) AS norm FROM tf GROUP BY {key}),
anchor AS (SELECT term, n FROM tf WHERE {key} = {anchor}),
dots AS (SELECT {key}, sum(tf.n * anchor.n) AS dot FROM tf JOIN anchor USING (term) GROUP BY {key}),
cosine AS (
  SELECT {key}, round(coalesce(dot, 0) / (norm * (SELECT norm FROM norms WHERE {key} = {anchor})), 6)
         AS cosine_to_anchor
  FROM norms LEFT JOIN dots USING ({key}))"""


@registry.add(
    "cosine_terms_to_anchor",
    f"""WITH {_cosine_sql("documents", "doc_id", "text", "1")}
        SELECT doc_id, cosine_to_anchor FROM documents LEFT JOIN cosine USING (doc_id)""",
)
def _(spark, sf):
    docs = load(spark, sf, "documents", "doc_id", "text").select(
        "doc_id", X.without_words(X.word_tokens("text")).alias("tokens")
    )
    scored = similarity.term_cosine(docs, docs.where(F.col("doc_id") == 1), "doc_id")
    return scored.withColumn("cosine_to_anchor", F.round("cosine_to_anchor", 6))


@registry.add(
    "similar_pages",
    rf"""{CORPUS_LABELS}, pages_of AS (
          SELECT * FROM labelled WHERE label IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY target_uri ORDER BY length(text_norm) DESC, record_id) = 1),
        {_cosine_sql("pages_of", "target_uri", "text_norm", "(SELECT min(target_uri) FROM pages_of)")}
        SELECT target_uri, label, cosine_to_anchor FROM pages_of JOIN cosine USING (target_uri)
        WHERE NOT contains(target_uri, (SELECT regexp_extract(min(target_uri),
              '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1) FROM pages_of))
        ORDER BY cosine_to_anchor DESC, target_uri LIMIT 20""",
)
def _(spark, sf):
    # read for the first URI, for its page and for the others, so labelled once and stored
    labelled = cut_lineage(signals.label_pages(corpus(spark, sf)).select("record_id", "target_uri", "label", "text_norm"))
    pages = labelled.withColumn("tokens", X.without_words(X.word_tokens("text_norm")))
    first = labelled.agg(F.min("target_uri")).scalar()
    marked = pages.withColumn("_anchor_uri", first)
    anchor = similarity.one_page_per_uri(marked.where(F.col("target_uri") == F.col("_anchor_uri")))
    # every version is scored where it is; the report then needs no text
    outside = similarity.one_page_per_uri(
        similarity.with_term_cosine(similarity.without_host(marked, authority("_anchor_uri")), anchor),
        keep=["label", "cosine_to_anchor"],
    )
    return similarity.most_similar(
        outside.select("target_uri", "label", F.round("cosine_to_anchor", 6).alias("cosine_to_anchor")),
        tiebreak="target_uri",
    )


# --- hashed features and classifiers ------------------------------------------------------------------


@registry.add("hashed_tf")
def _(spark, sf):
    docs = load(spark, sf, "documents", "doc_id", "text")
    return features.hashed_term_rows(docs, "doc_id", text_col="text")


@registry.add(
    "hashed_tf_totals",
    f"""SELECT doc_id, CAST(len(words) AS DOUBLE) AS n_terms FROM (
          SELECT doc_id, list_filter({TERMS_SQL.format("text")}, lambda t: t NOT IN {STOP}) AS words FROM documents)
        WHERE len(words) > 0""",
)
def _(spark, sf):
    # terms that share a bucket add up, so the sum is the number of terms whatever the hash
    docs = load(spark, sf, "documents", "doc_id", "text")
    return features.hashed_term_rows(docs, "doc_id", text_col="text").groupBy("doc_id").agg(F.sum("tf").alias("n_terms"))


@registry.add("cosine_hashed")
def _(spark, sf):
    vectors = features.hashed_terms(load(spark, sf, "documents", "doc_id", "text"), "text").drop("text")
    anchor = vectors.where(F.col("doc_id") == 1)
    scored = similarity.with_hashed_cosine(vectors, anchor, features.NUM_FEATURES)
    return scored.select("doc_id", F.round("cosine_to_anchor", 6).alias("cosine_to_anchor"))


@registry.add("similar_pages_hashed")
def _(spark, sf):
    gold = cut_lineage(
        signals.label_pages(corpus(spark, sf)).select(
            "record_id", "target_uri", "label", "num_density", "has_any_census", "text_norm"
        )
    )
    first = gold.agg(F.min("target_uri")).first()[0]
    similar = modelling.similar_pages(gold, first)
    return similar.withColumn("cosine_to_anchor", F.round("cosine_to_anchor", 6))


def _classifier(kind: str) -> None:
    @registry.add(f"{kind}_predictions")
    def _(spark, sf):
        # the labelled pages are read many times, so they are stored once, as a gold table would be
        gold = cut_lineage(_labelled(spark, sf).select("doc_id", "label", "text_norm"))
        weighted = features.with_class_weight(gold)
        train, test = sampling.split_by_key(weighted, "doc_id")
        scored = classify.score(classify.train(train, kind), test)
        return scored.select("doc_id", "label", "predicted_label")


_classifier("lr")
_classifier("svm")


