"""Appends of unseen keys: what is read of the target, and that nothing is lost by it."""

import uuid

from pyspark.sql import functions as F

from crawlprism.sources import tables


def name(_: str = "") -> str:
    return "a" + uuid.uuid4().hex


def objects(spark, low, high, step=1):
    return spark.range(low, high, step).select(
        F.format_string("crawl-%02d/%06d", (F.col("id") / 1000).cast("int"), "id").alias("obj_key"),
        F.format_string("crawl-%02d", (F.col("id") / 1000).cast("int")).alias("crawl"),
        F.col("id").alias("n"),
    )


def test_only_touched_partitions_and_row_groups_are_read(spark, plan):
    t = name()
    tables.append(objects(spark, 0, 20_000), t, "obj_key", "crawl")
    batch = objects(spark, 17_500, 18_500)
    reach = tables.within_reach(spark.read.table(t), batch, "obj_key", "crawl")
    text = plan(reach)
    assert "PartitionFilters: [crawl" in text.replace("isnotnull(crawl#", "crawl#") and "crawl-17" in text and "crawl-18" in text
    assert ">= crawl-17/017500" in text and "<= crawl-18/018499" in text and "OrEqual(obj_key,crawl-17/017500)" in text
    assert len({r[0] for r in reach.select(F.input_file_name()).distinct().collect()}) < spark.read.table(t).select(F.input_file_name()).distinct().count() / 5
    tables.append(batch, t, "obj_key", "crawl")
    tables.append(objects(spark, 19_500, 21_000), t, "obj_key", "crawl")
    assert sorted(r["n"] for r in spark.read.table(t).select("n").collect()) == list(range(21_000))


def test_null_keys_and_partitions(spark):
    t = name()
    first = [("a", "p", 1), (None, "p", 2), ("c", None, 3)]
    schema = "obj_key string, crawl string, n int"
    tables.append(spark.createDataFrame(first, schema), t, "obj_key", "crawl")
    tables.append(spark.createDataFrame([("c", None, 4), (None, None, 5), ("b", "q", 6), ("a", "p", 7)], schema), t, "obj_key", "crawl")
    assert sorted(r["n"] for r in spark.read.table(t).collect()) == [1, 2, 3, 5, 6]
    tables.append(spark.createDataFrame([], schema), t, "obj_key", "crawl")
    tables.append(spark.createDataFrame([(None, "p", 8)], schema), t, "obj_key", "crawl")
    assert sorted(r["n"] for r in spark.read.table(t).collect()) == [1, 2, 3, 5, 6, 8]


def test_a_batch_of_very_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(tables, "MAX_PARTITIONS", 3)
    t = name()
    tables.append(objects(spark, 0, 8_000, 50), t, "obj_key", "crawl")
    tables.append(objects(spark, 0, 8_000, 25), t, "obj_key", "crawl")
    assert sorted(r["n"] for r in spark.read.table(t).select("n").collect()) == list(range(0, 8_000, 25))


def test_numeric_keys_are_bounded_as_numbers(spark):
    t = name()
    tables.append(spark.range(0, 1_000).toDF("k"), t, "k")
    tables.append(spark.range(5, 1_200).toDF("k"), t, "k")
    assert spark.read.table(t).count() == 1_200
