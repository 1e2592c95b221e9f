"""Binary classification metrics as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlprism.operators.numbering import with_running_totals


def confusion(df: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    return df.groupBy(label_col, prediction_col).agg(F.count(F.lit(1)).alias("n"))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole)


def precision_recall(
    df: DataFrame, positive, label_col: str = "label", prediction_col: str = "prediction"
) -> DataFrame:
    """tp, fp, fn, tn, precision and recall of one class in one pass; NULL where the divisor is 0."""
    real, said = F.col(label_col) == positive, F.col(prediction_col) == positive
    counts = df.agg(
        F.count_if(real & said).alias("tp"),
        F.count_if(~real & said).alias("fp"),
        F.count_if(real & ~said).alias("fn"),
        F.count_if(~real & ~said).alias("tn"),
    )
    tp = F.col("tp")
    return counts.withColumns(
        {"precision": _share(tp, tp + F.col("fp")), "recall": _share(tp, tp + F.col("fn"))}
    )


def area_under_roc(df: DataFrame, score_col: str, positive: Column) -> DataFrame:
    """Exact area under the ROC curve.

    Each distinct score meets the positives above it plus half of those tied with it.
    Rows are first counted per score, so the ordered step sees distinct scores only, and
    it is a distributed running total rather than one global window.
    """
    per_score = df.groupBy(F.col(score_col).cast("double").alias("score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    ranked = with_running_totals(per_score, ["score"], {"pos_to_here": "pos"})
    totals = ranked.agg(
        F.sum("pos").alias("p"),
        F.sum("neg").alias("n"),
        # positives at or below a score, less half its own: wins of negatives over positives
        F.sum(F.col("neg") * (F.col("pos_to_here") - F.col("pos") / 2)).alias("lost"),
    )
    pairs = F.col("p").cast("double") * F.col("n")
    return totals.select(_share(pairs - F.col("lost"), pairs).alias("auc"))


def weighted_f1(df: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    """F1 of each class weighted by its share of the rows."""
    cells = confusion(df, label_col, prediction_col)
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(
                    F.col(label_col).alias("cls"),
                    F.col("n").alias("real"),
                    F.lit(0).cast("bigint").alias("said"),
                    F.when(F.col(label_col) == F.col(prediction_col), F.col("n")).otherwise(0).alias("hit"),
                ),
                F.struct(
                    F.col(prediction_col).alias("cls"),
                    F.lit(0).cast("bigint").alias("real"),
                    F.col("n").alias("said"),
                    F.lit(0).cast("bigint").alias("hit"),
                ),
            )
        )
    )
    per_class = sides.groupBy("cls").agg(
        F.sum("real").alias("real"), F.sum("said").alias("said"), F.sum("hit").alias("hit")
    )
    # 2PR / (P + R) = 2 hit / (real + said)
    f1 = F.col("hit").cast("double") * 2 / (F.col("real") + F.col("said"))
    return per_class.agg((F.sum(F.col("real") * f1) / F.sum("real")).alias("f1"))
