"""Label index, class weights and hashed term features."""

from __future__ import annotations

from pyspark.ml.feature import HashingTF, RegexTokenizer, StopWordsRemover
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlprism.operators import dictionaries as D

NUM_FEATURES = 2**12


def label_counts(df: DataFrame, label_col: str = "label") -> DataFrame:
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))


def label_index(df: DataFrame, label_col: str = "label") -> DataFrame:
    """label -> index, the most frequent label first, ties by name.

    Rows are counted first; the ranking sees one row per class. NULL labels have no index.
    """
    counts = label_counts(df, label_col).where(F.col(label_col).isNotNull())
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("rank"), F.col(label_col).alias("label"))))
    return counts.agg(ordered.alias("classes")).select(
        F.posexplode(F.transform("classes", lambda s: s["label"])).alias("label_idx", label_col)
    )


def class_weights(df: DataFrame, label_col: str = "label") -> DataFrame:
    """label -> largest class count / own count. The window spans one row per class, not the pages."""
    counts = label_counts(df, label_col).where(F.col(label_col).isNotNull())
    largest = F.max("n").over(Window.partitionBy())
    return counts.select(label_col, (largest.cast("double") / F.col("n")).alias("class_weight"))


def with_class_weight(
    df: DataFrame, label_col: str = "label", weights: DataFrame | None = None
) -> DataFrame:
    """Attach the weight of each row's class; a class without a weight gets 1.0.

    The weight table has one row per class and is broadcast: dealt by class, a page's text would move, and all pages
    of a class would be one task, also in the classifier, which keeps the partitions it is given.
    """
    weights = class_weights(df, label_col) if weights is None else weights
    joined = df.join(F.broadcast(weights), label_col, "left")
    return joined.withColumn("class_weight", F.coalesce("class_weight", F.lit(1.0)))


def tokenizer(text_col: str = "text_norm") -> RegexTokenizer:
    return RegexTokenizer(inputCol=text_col, outputCol="tokens", pattern="\\W")


def stop_word_remover(words: list[str] | None = None) -> StopWordsRemover:
    return StopWordsRemover(inputCol="tokens", outputCol="filtered", stopWords=words or D.ENGLISH_STOP_WORDS)


def hashing(num_features: int = NUM_FEATURES) -> HashingTF:
    return HashingTF(inputCol="filtered", outputCol="tf_raw", numFeatures=num_features)


def text_stages(text_col: str = "text_norm", num_features: int = NUM_FEATURES) -> list:
    return [tokenizer(text_col), stop_word_remover(), hashing(num_features)]


def hashed_terms(
    df: DataFrame, text_col: str = "text_norm", num_features: int = NUM_FEATURES
) -> DataFrame:
    """Adds ``tf_raw``. The three stages have nothing to fit, so no pass over the data is made."""
    out = df
    for stage in text_stages(text_col, num_features):
        out = stage.transform(out)
    return out.drop("tokens", "filtered")


def hashed_term_rows(df: DataFrame, id_col: str, **kwargs) -> DataFrame:
    """(id, bucket, tf) rows of the hashed vectors."""
    parts = F.unwrap_udt("tf_raw")
    pairs = F.arrays_zip(parts["indices"].alias("bucket"), parts["values"].alias("tf"))
    return hashed_terms(df, **kwargs).select(id_col, F.inline(pairs))
