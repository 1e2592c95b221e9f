"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from crawlprism.llm import alignment, bpe, decontaminate, language_id, licences, near_dup, pii, prefix_trie, quality, suffix_dedup, token_files, url_filter, warc
from crawlprism.llm.common import bound_batches, table
from crawlprism.registry.base import Query

registry: dict[str, Query] = {}


def _add(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            bound_batches(spark)
            return build(spark, sf_dir)

        registry[name] = Query(run, sql)
        return build

    return register


_add("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)


@_add("op1_licences")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return licences.licences(docs, licences.fit(docs))


@_add("op2_decontaminate", decontaminate.SQL)
def op2(spark, sf_dir):
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


@_add("op6_token_files")
def op6(spark, sf_dir):
    return token_files.token_round_trip(table(spark, sf_dir, "documents"), special=True)


@_add("op7_quality", quality.SQL)
def op7(spark, sf_dir):
    return quality.digest(quality.repetition(table(spark, sf_dir, "documents")))


@_add("op3_bpe")
def op3(spark, sf_dir):
    return bpe.digest(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"))))


@_add("op4_near_dup", near_dup.SQL)
def op4(spark, sf_dir):
    # shingles of two words are this query's contract; the operator and the pipeline take five
    return near_dup.digest(near_dup.near_duplicates(table(spark, sf_dir, "documents"), width=2))


@_add("op5_warc", warc.SQL)
def op5(spark, sf_dir):
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


@_add("op8_pii")
def op8(spark, sf_dir):
    return pii.digest(pii.personal_data(table(spark, sf_dir, "documents")))


@_add("op9_suffix_dedup", suffix_dedup.SQL)
def op9(spark, sf_dir):
    return suffix_dedup.digest(suffix_dedup.without_repeats(table(spark, sf_dir, "documents")))


@_add("op10_language")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language_id.digest(docs, language_id.predictions(docs, language_id.training_sample(docs)))


@_add("op11_url_filter", url_filter.SQL)
def op11(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return url_filter.verdicts(pages, url_filter.listed_urls(url_filter.pages_of_sites(pages)))


@_add("op13_prefix_trie", prefix_trie.SQL)
def op13(spark, sf_dir):
    return prefix_trie.digest(prefix_trie.trie(prefix_trie.rebuilt(table(spark, sf_dir, "conversations"))))


@_add("op12_alignment")
def op12(spark, sf_dir):
    return alignment.digest(alignment.aligned(table(spark, sf_dir, "documents")))
