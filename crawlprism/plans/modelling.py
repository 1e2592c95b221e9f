"""Classifier training and the similar-page search over the gold table."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlprism.operators import classify, features, sampling, similarity


def train_and_evaluate(
    gold: DataFrame, kind: str = "lr", key: str = "record_id", include_heuristics: bool = False
) -> tuple[PipelineModel, classify.Evaluation]:
    """Weight classes, split by key, fit, and evaluate on the test side."""
    weighted = features.with_class_weight(gold)
    train_rows, test_rows = sampling.split_by_key(weighted, key)
    model = classify.train(train_rows, kind, include_heuristics=include_heuristics)
    return model, classify.evaluate(classify.score(model, test_rows))


def similar_pages(gold: DataFrame, anchor_uri: str, k: int = 20) -> DataFrame:
    """The ``k`` pages most similar to the anchor, outside the anchor's host."""
    shown = ["label", "cosine_to_anchor", "num_density", "has_any_census"]
    vectors = features.hashed_terms(
        gold.select("record_id", "target_uri", "label", "num_density", "has_any_census", "text_norm")
    )
    # the anchor is looked up among its own URI's rows, not in the de-duplicated corpus
    own = gold.where(F.col("target_uri") == anchor_uri)
    similarity.find_anchor(own, anchor_uri)
    anchor = features.hashed_terms(similarity.one_page_per_uri(own))
    scored = similarity.with_hashed_cosine(
        similarity.without_host(vectors, similarity.anchor_host(anchor_uri)), anchor, features.NUM_FEATURES
    )
    # every version is scored where it is; one row per page is chosen without moving text
    unique = similarity.one_page_per_uri(scored, keep=shown)
    return similarity.most_similar(unique.select("target_uri", *shown, "record_id"), k).drop("record_id")
