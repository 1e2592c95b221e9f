"""Features, metrics, similarity and classifiers against MLlib and numpy."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from crawlprism.functions import text as X
from crawlprism.functions import vectors as V
from crawlprism.operators import classify, features, metrics, sampling, signals, similarity
from crawlprism.plans import modelling
from crawlprism.registry.fixtures import corpus, load, salted
from crawlprism.session import cut_lineage


@pytest.fixture(scope="module")
def gold(spark, sf):
    return cut_lineage(signals.label_pages(corpus(spark, sf)))


@pytest.fixture(scope="module")
def larger(spark):
    return cut_lineage(signals.label_pages(corpus(spark, "/root/testdata/sf0.01")))


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(7)
    rows = [(float(l), float(s), float(s > 0.5)) for l, s in zip(rng.integers(0, 2, 400), rng.integers(0, 20, 400) / 20)]
    return spark.createDataFrame(rows, "label double, score double, prediction double")


def test_auc_equals_mllib(scored):
    want = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score").evaluate(scored)
    got = metrics.area_under_roc(scored, "score", F.col("label") == 1).first()["auc"]
    assert got == pytest.approx(want, abs=1e-12)


def test_auc_of_one_class_is_null(scored):
    one = scored.where("label = 1")
    assert metrics.area_under_roc(one, "score", F.col("label") == 1).first()["auc"] is None


def test_f1_equals_mllib(scored):
    want = MulticlassClassificationEvaluator(labelCol="label", metricName="f1").evaluate(scored)
    assert metrics.weighted_f1(scored).first()["f1"] == pytest.approx(want, abs=1e-12)


def test_precision_without_predictions_is_null(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "b")], "label string, prediction string")
    row = metrics.precision_recall(df, "a").first()
    assert (row["precision"], row["recall"], row["fn"], row["tn"]) == (None, 0.0, 1, 1)


def test_unknown_class_weighs_one(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "label string")
    weights = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "label string, class_weight double")
    rows = features.with_class_weight(df, weights=weights).collect()
    assert sorted((r["label"], r["class_weight"]) for r in rows) == [("a", 1.0), ("a", 1.0), ("b", 2.0), ("c", 1.0)]


def test_classes_are_not_brought_together(spark):
    """Rows keep their partitions, whatever their class: a class is not one task of the classifier."""
    df = cut_lineage(spark.range(7000, numPartitions=7).select("id", F.expr("if(id % 3 = 0, 'a', 'b') as label")))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = features.with_class_weight(df).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sizes == [1000] * 7


def test_tokens_equal_the_ml_stages(spark, sf):
    docs = load(spark, sf, "documents", "doc_id", "text")
    staged = features.stop_word_remover().transform(features.tokenizer("text").transform(docs))
    both = staged.select(
        (F.col("tokens") == X.word_tokens("text")).alias("a"),
        (F.col("filtered") == X.without_words(X.word_tokens("text"))).alias("b"),
    )
    assert both.where("not (a and b)").count() == 0


def test_hashed_rows_sum_to_token_counts(spark, sf):
    docs = load(spark, sf, "documents", "doc_id", "text")
    rows = features.hashed_term_rows(docs, "doc_id", text_col="text").groupBy("doc_id").agg(F.sum("tf").alias("n"))
    sizes = docs.select("doc_id", F.size(X.without_words(X.word_tokens("text"))).alias("m"))
    assert rows.join(sizes, "doc_id", "full").where("coalesce(n, 0) <> m").count() == 0


def test_term_norm(spark):
    df = spark.createDataFrame([(["a", "b", "a", "a"],), ([],), (["x"],)], "t array<string>")
    assert [r[0] for r in df.select(V.squared_term_norm(F.col("t"))).collect()] == [10, 0, 1]


def test_term_cosine_against_brute_force(spark, sf):
    docs = load(spark, sf, "documents", "doc_id", "text").select("doc_id", X.word_tokens("text").alias("tokens"))
    rows = {r["doc_id"]: r["tokens"] for r in docs.collect()}
    scores = similarity.term_cosine(docs, docs.where("doc_id = 3"), "doc_id")
    anchor = {t: rows[3].count(t) for t in set(rows[3])}
    for r in scores.collect():
        tf = {t: rows[r["doc_id"]].count(t) for t in set(rows[r["doc_id"]])}
        norm = np.sqrt(sum(v * v for v in tf.values())) * np.sqrt(sum(v * v for v in anchor.values()))
        want = sum(v * anchor.get(t, 0) for t, v in tf.items()) / norm if norm else None
        assert r["cosine_to_anchor"] == (pytest.approx(want) if want is not None else None)


def test_term_cosine_of_repeated_rows(spark, plan):
    """Rows that share an id are scored each for itself, without an explode."""
    df = spark.createDataFrame(
        [(1, ["a", "b", "a"]), (1, ["a", "b", "a"]), (1, ["c"]), (2, []), (2, ["b"])], "i int, tokens array<string>"
    )
    scores = similarity.term_cosine(df, df.where("i = 1").limit(1), "i")
    got = sorted((r[0], -1 if r[1] is None else round(r[1], 6)) for r in scores.collect())
    assert got == [(1, 0.0), (1, 1.0), (1, 1.0), (2, -1), (2, 0.447214)]
    assert "Generate" not in plan(scores)


def test_hashed_cosine_against_vectors(spark, sf):
    vectors = features.hashed_terms(load(spark, sf, "documents", "doc_id", "text"), "text")
    local = {r["doc_id"]: r["tf_raw"] for r in vectors.collect()}
    a = local[3]
    out = similarity.with_hashed_cosine(vectors, vectors.where("doc_id = 3"), features.NUM_FEATURES)
    for r in out.select("doc_id", "cosine_to_anchor").collect():
        v = local[r["doc_id"]]
        norm = np.sqrt(v.dot(v)) * np.sqrt(a.dot(a))
        assert r["cosine_to_anchor"] == (pytest.approx(v.dot(a) / norm) if norm else None)


def test_zero_vectors_have_no_cosine(spark):
    df = spark.createDataFrame(
        [(0, [0.0, 0.0], Vectors.sparse(4, [], [])), (1, [3.0, 4.0], Vectors.sparse(4, [0, 2], [3.0, 4.0]))],
        ["id", "embedding", "tf_raw"],
    )
    for anchor, want in ((1, [None, 1.0]), (0, [None, None])):
        one = df.where(F.col("id") == anchor)
        dense = similarity.with_dense_cosine(df, one).orderBy("id").collect()
        hashed = similarity.with_hashed_cosine(df, one, 4).orderBy("id").collect()
        assert [r["cosine_to_anchor"] for r in dense] == want
        assert [r["cosine_to_anchor"] for r in hashed] == want


def test_anchor_must_exist(spark, gold):
    with pytest.raises(ValueError):
        similarity.find_anchor(gold, "https://nowhere.example/")


def test_one_page_per_uri_limits_before_the_shuffle(gold, plan):
    out = similarity.one_page_per_uri(gold.select("target_uri", "record_id", "text_norm"))
    assert plan(out).count("WindowGroupLimit") == 2
    assert out.count() == gold.select("target_uri").distinct().count()


def test_similar_pages(gold):
    uri = gold.agg(F.min("target_uri")).first()[0]
    rows = modelling.similar_pages(gold, uri, k=5).collect()
    host = similarity.anchor_host(uri)
    assert len(rows) == 5 and all(host not in r["target_uri"] for r in rows)
    scores = [r["cosine_to_anchor"] for r in rows]
    assert scores == sorted(scores, reverse=True) and scores[0] <= 1.0 + 1e-9


@pytest.mark.parametrize("kind", ["lr", "svm"])
def test_training_beats_the_majority(spark, larger, kind, tmp_path):
    model, result = modelling.train_and_evaluate(larger, kind)
    _, test_rows = sampling.split_by_key(larger, "record_id")
    names = classify.class_names(model)
    baseline = metrics.weighted_f1(test_rows.select("label", F.lit(names[0]).alias("prediction"))).first()["f1"]
    assert result.auc > 0.8 and result.recall > 0.5 and result.f1 > baseline + 0.1
    assert sum(r["n"] for r in result.confusion.collect()) == test_rows.count()
    model.write().overwrite().save(str(tmp_path / "m"))
    from pyspark.ml import PipelineModel

    again = PipelineModel.load(str(tmp_path / "m"))
    assert classify.class_names(again) == classify.class_names(model)


def test_heuristic_features_and_class_order(spark, sf):
    pages = signals.label_pages(salted(spark, sf))
    # make "repackages" the majority: predictions must still be read by name
    flipped = pages.where("label = 'repackages' or doc_id % 20 = 0")
    weighted = cut_lineage(features.with_class_weight(flipped))
    model = classify.train(weighted, "lr", include_heuristics=True)
    assert classify.class_names(model)[0] == "repackages"
    scored = classify.score(model, weighted)
    assert metrics.precision_recall(scored, "repackages", "label", "predicted_label").first()["recall"] > 0.9
    with pytest.raises(ValueError):
        classify.stages("tree")


def test_split_sides(gold):
    train, test = sampling.split_by_key(gold, "record_id")
    assert train.count() + test.count() == gold.count()
