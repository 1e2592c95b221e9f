"""Unseen keys, unions, sampling and the object catalog."""

import pytest
from pyspark.sql import functions as F

from crawlprism.operators import joins, sampling
from crawlprism.sources import manifest as M


def keys(df, c="obj_key"):
    return sorted(r[c] or "" for r in df.select(c).collect())


def test_null_keys_are_kept(spark):
    left = spark.createDataFrame([("a",), ("b",), ("b",), (None,), (None,), ("",)], "obj_key string")
    seen = spark.createDataFrame([("a",), (None,), ("a",)], "obj_key string")
    assert keys(joins.exclude_seen(left, seen)) == ["", "", "", "b", "b"]


def test_hot_key_is_split_by_adaptive_execution(spark, plan):
    left = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("obj_key"),
        F.md5(F.col("id").cast("string")).alias("pad"),
    )
    seen = spark.range(0, 200_000, 7).select(F.col("id").cast("string").alias("obj_key"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = joins.exclude_seen(left, seen)
        n = out.count()
        out.collect()
        text = plan(out)
        assert "skew=true" in text, text
    finally:
        for k in conf:
            spark.conf.unset(k)
    gone = len([i for i in range(0, 200_000, 7) if i % 3])
    assert n == 200_000 - gone


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([(2,)], "a int")
    assert sorted(map(tuple, joins.union_all([a, b]).collect())) == [(1, "x"), (2, None)]
    with pytest.raises(RuntimeError):
        joins.union_all([])


def test_prefix_checks(spark):
    assert M.normalize_prefix("a") == "a/" == M.normalize_prefix("a/")
    for bad in ("", None, 3):
        with pytest.raises(ValueError):
            M.normalize_prefix(bad)


def test_prefix_list_keeps_first_seen_order(spark):
    rows = [(0, " b "), (1, "a/"), (2, "b/"), (3, ""), (4, "a")]
    df = spark.createDataFrame(rows, "pos int, p string")
    assert [r["prefix"] for r in M.prefix_list(df, "p", "pos").collect()] == ["b/", "a/", "/"]


def test_ingest_skips_empty_prefixes(spark):
    df = spark.createDataFrame([("crawl-data/A/x",), ("crawl-data/B/y",)], "obj_key string")
    out = M.ingest_crawls(df, ["crawl-data/A", "crawl-data/C/"])
    assert [tuple(r) for r in out.collect()] == [("crawl-data/A/x", "crawl-data/A/")]
    frame = spark.createDataFrame([(" crawl-data/B",), ("crawl-data/B/",)], "p string")
    assert keys(M.ingest_crawls(df, frame)) == ["crawl-data/B/y"]
    with pytest.raises(RuntimeError):
        M.require_rows(M.ingest_crawls(df, ["crawl-data/C"]))
    with pytest.raises(RuntimeError):
        M.ingest_crawls(df, [])
    assert M.list_crawls(df, "crawl-data/Z").count() == 0


def test_bad_stamps_become_null(spark):
    df = spark.createDataFrame(
        [("x/CC-MAIN-20240101000000-20240101030000-1",), ("x/CC-MAIN-99999999999999-20240101030000-1",), ("x",)],
        "obj_key string",
    )
    rows = M.with_crawl_times(df).collect()
    assert [r["crawl_start"] is None for r in rows] == [False, True, True]
    assert rows[1]["crawl_end"] is not None


def test_object_manifest(spark, tmp_path, plan):
    (tmp_path / "crawl-data" / "A").mkdir(parents=True)
    (tmp_path / "crawl-data" / "A" / "one.wet").write_text("abc")
    (tmp_path / "crawl-data" / "two.txt").write_text("x")
    listing = M.object_manifest(spark, str(tmp_path))
    assert sorted((r["obj_key"].rsplit("/", 1)[1], r["size"]) for r in listing.collect()) == [
        ("one.wet", 3),
        ("two.txt", 1),
    ]
    assert M.object_manifest(spark, str(tmp_path), "*.wet").count() == 1
    assert "content" not in plan(listing)
    assert '"size":3' in M.as_json(listing.where("size > 1")).first()["json"]


def test_sampling_is_one_window_with_a_map_side_limit(spark, sf, plan):
    from crawlprism.registry.fixtures import crawl_manifest

    text = plan(sampling.sample_crawls(M.dated_crawls(crawl_manifest(spark, sf)), ["1996"], 2))
    assert text.count("WindowGroupLimit") == 2


def test_latest(spark):
    df = spark.createDataFrame([("a",), ("c",), ("b",)], "x string")
    assert sampling.latest(df, "x") == "c"
    with pytest.raises(ValueError):
        sampling.latest(df.where("false"), "x")


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(2000)
    a = {r["id"] for r in sampling.split_by_key(df.repartition(3), "id")[0].collect()}
    train, test = sampling.split_by_key(df.repartition(7), "id")
    assert a == {r["id"] for r in train.collect()}
    assert train.count() + test.count() == 2000 and 1500 < len(a) < 1700
