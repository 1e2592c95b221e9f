"""Train, score and evaluate the page classifiers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlprism.operators import features as FT
from crawlprism.operators import metrics
from crawlprism.session import cut_lineage

HEURISTIC_FEATURES = ["num_density", "has_any_census"]

# Training settings.
SETTINGS = {
    "svm": (LinearSVC, {"maxIter": 50, "regParam": 0.1}),
    "lr": (LogisticRegression, {"maxIter": 30, "regParam": 0.1}),
}


def stages(kind: str, text_col: str = "text_norm", include_heuristics: bool = False) -> list:
    if kind not in SETTINGS:
        raise ValueError(f"kind must be one of {sorted(SETTINGS)}")
    estimator, settings = SETTINGS[kind]
    inputs = ["tf_raw", *(HEURISTIC_FEATURES if include_heuristics else [])]
    return [
        StringIndexer(inputCol="label", outputCol="label_idx"),
        *FT.text_stages(text_col),
        VectorAssembler(inputCols=inputs, outputCol="features"),
        estimator(featuresCol="features", labelCol="label_idx", weightCol="class_weight", **settings),
    ]


def heuristic_doubles(df: DataFrame) -> DataFrame:
    present = [c for c in HEURISTIC_FEATURES if c in df.columns]
    return df.withColumns({c: F.col(c).cast("double") for c in present}) if present else df


def train(df: DataFrame, kind: str = "lr", text_col: str = "text_norm", include_heuristics: bool = False) -> PipelineModel:
    """Fit on rows with ``label`` and ``class_weight``. Only the needed columns reach the iterations."""
    needed = ["label", "class_weight", text_col, *(HEURISTIC_FEATURES if include_heuristics else [])]
    return Pipeline(stages=stages(kind, text_col, include_heuristics)).fit(heuristic_doubles(df).select(*needed))


def class_names(model: PipelineModel) -> list[str]:
    return next(s for s in model.stages if isinstance(s, StringIndexerModel)).labels


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Predictions with the predicted class by name, whatever index it was given."""
    names = F.array(*[F.lit(n) for n in class_names(model)])
    return model.transform(heuristic_doubles(df)).withColumn(
        "predicted_label", F.get(names, F.col("prediction").cast("int"))
    )


@dataclass(frozen=True)
class Evaluation:
    auc: float
    f1: float
    precision: float | None
    recall: float | None
    confusion: DataFrame


def evaluate(scored: DataFrame, positive: str = "repackages") -> Evaluation:
    """AUC, weighted F1, the confusion matrix, and precision and recall of one named class.

    The four passes read the scores from a checkpoint and do not score again.
    """
    scored = cut_lineage(scored.select("label", "label_idx", "rawPrediction", "prediction", "predicted_label"))
    auc = BinaryClassificationEvaluator(
        labelCol="label_idx", rawPredictionCol="rawPrediction", metricName="areaUnderROC"
    ).evaluate(scored)
    f1 = MulticlassClassificationEvaluator(
        labelCol="label_idx", predictionCol="prediction", metricName="f1"
    ).evaluate(scored)
    one = metrics.precision_recall(scored, positive, "label", "predicted_label").first()
    table = metrics.confusion(scored, "label", "predicted_label").orderBy("label", "predicted_label")
    return Evaluation(auc, f1, one["precision"], one["recall"], table)
