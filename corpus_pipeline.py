"""A corpus pipeline in five stages, each calling one operator of crawlprism.llm.

A stage takes (spark, docs, sf_dir) and returns a frame; it is written as Parquet and read again as the next one's docs. All
but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from crawlprism.llm import bpe, decontaminate, language_id, near_dup, pii
from crawlprism.llm.common import bound_batches, stored, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text or without a letter go: null, empty and blank texts, digits and signs. All others stay, whatever
    their language, also where no label was there to learn from. Repeated rows are judged alike; null ids stay.
    """
    bound_batches(spark)
    return language_id.keep_identified(docs, language_id.training_sample(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, by shingles of five words, the document with the smallest id stays.

    Of rows that share that id and text one stays. A text that is null or has no word is linked with nothing and stays. A null id loses
    against any other; texts of any length are compared whole.
    """
    bound_batches(spark)
    return near_dup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of the benchmark occurs go. Null and empty texts and benchmark items have no window; repeated rows
    are judged alike; with an empty benchmark all stay.
    """
    bound_batches(spark)
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to its kind in brackets, and ``n_chars`` follows the text. Where spans overlap, the leftmost counts, of
    those that begin together the longest; null texts stay null; every row stays, repeated ones too.
    """
    bound_batches(spark)
    return pii.redacted(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes, one row for each document. Null text is empty; repeated rows give
    repeated rows.
    """
    bound_batches(spark)
    return bpe.digest(bpe.decode(bpe.encode(docs)))


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("bpe", encode),
]

# Language models and merges of byte pairs are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
