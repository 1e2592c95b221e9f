"""Global numbering: equal to the one-task window, without its single task."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from crawlprism.operators import numbering
from crawlprism.registry.fixtures import load
from crawlprism.session import width_for


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, some keys are NULL."""
    ids = spark.range(3000).withColumn(
        "key", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.md5(F.col("id").cast("string")))
    )
    return ids.repartition(6)


def test_equals_row_number_on_unique_ids(spark, sf):
    docs = load(spark, sf, "documents", "doc_id").withColumn("rid", F.md5(F.col("doc_id").cast("string")))
    got = numbering.with_row_number(docs, ["rid"]).select("rid", "row_num")
    want = docs.select("rid", F.row_number().over(Window.orderBy("rid")).alias("row_num"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_hot_key_is_spread_and_numbers_are_dense(spark, skewed):
    out = numbering.with_row_number(skewed, ["key"], partitions=8)
    rows = sorted(out.select("row_num", "key").collect())
    assert [r["row_num"] for r in rows] == list(range(1, 3001))
    keys = [r["key"] or "" for r in rows]
    assert keys == sorted(keys)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 900  # the hot key alone has 1000 rows


def test_rows_are_kept_whole(spark, skewed):
    out = numbering.with_row_number(skewed, ["key"])
    assert sorted(map(tuple, out.select("id", "key").collect()), key=str) == sorted(
        map(tuple, skewed.collect()), key=str
    )


def test_running_totals(spark):
    df = spark.range(500).select("id", (F.col("id") % 7).alias("v"), (F.col("id") * 2).alias("w"))
    out = numbering.with_running_totals(df.repartition(5), ["id"], {"a": "v", "b": "w"})
    over = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("id", F.sum("v").over(over), F.sum("w").over(over))
    assert sorted(map(tuple, out.select("id", "a", "b").collect())) == sorted(map(tuple, want.collect()))


def test_running_totals_take_one_exchange_of_the_rows(spark, plan):
    df = spark.range(500).select("id", F.when(F.col("id") % 3 > 0, F.col("id") / 4).alias("v"), F.lit("x").alias("text"))
    out = numbering.with_running_totals(df.repartition(5), ["id"], {"a": "v"})
    rows_side = plan(out).split("BroadcastExchange")[0]
    assert "MapInArrow" in rows_side and "Exchange" not in rows_side and "Window" not in rows_side
    over = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("id", F.sum(F.coalesce("v", F.lit(0.0))).over(over))
    assert sorted(map(tuple, out.select("id", "a").collect())) == sorted(map(tuple, want.collect()))


def test_measured_width(spark):
    df = spark.range(1000).withColumn("t", F.repeat(F.lit("x"), 100)).withColumn("n", F.lit(None).cast("string"))
    assert width_for(df) == 8
    assert width_for(df, target_bytes=1240) == 100
    assert width_for(df.where("false")) == 8


def test_empty_input(spark):
    df = spark.createDataFrame([], "id int, v int")
    assert numbering.with_row_number(df, ["id"]).count() == 0
    assert numbering.with_running_totals(df, ["id"], {"t": "v"}).count() == 0


def test_lines_to_records(spark):
    lines = ["stray", "WARC/1.0", "a", "b", "WARC/1.0", "c"]
    df = spark.createDataFrame(list(enumerate(lines)), "pos int, value string")
    numbered = numbering.number_records(df, ["pos"])
    assert [r["record_no"] for r in numbered.orderBy("pos").collect()] == [0, 1, 1, 1, 2, 2]
    records = numbering.join_lines(numbered, ["pos"]).orderBy("record_no").collect()
    assert [r["record_text"] for r in records] == ["WARC/1.0\na\nb", "WARC/1.0\nc"]


def test_only_partition_totals_meet_in_one_task(spark, skewed, plan):
    text = plan(numbering.with_row_number(skewed, ["key"]))
    above, below = text.split("Exchange SinglePartition")
    assert "HashAggregate" in below.split("Scan")[0]
    assert "Window [row_number" not in text
