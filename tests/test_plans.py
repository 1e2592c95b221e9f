"""Table loads end to end, streams, and the shape of every registered plan."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from crawlprism.operators import ngrams, reports, signals
from crawlprism.plans import catalog, gold, silver
from crawlprism.registry import registry
from crawlprism.registry.fixtures import corpus, crawl_manifest, record_texts
from crawlprism.schemas import MANIFEST_COLUMNS
from crawlprism.session import checkpoint_dir
from crawlprism.sources import manifest as M
from crawlprism.sources import tables
from crawlprism.sources.wet import parse_all, record_separator
from crawlprism.streaming import ingest


@pytest.fixture
def name(request):
    """Table names that no other test uses."""
    stem = request.node.name.replace("[", "_").replace("]", "").lower()
    return lambda suffix: f"{stem}_{suffix}"


@pytest.fixture(scope="module")
def manifest(spark, sf):
    return crawl_manifest(spark, sf).drop("seen", "o_orderkey").withColumn("crawl_prefix", M.crawl_prefix())


# --- sinks ---------------------------------------------------------------------------


def test_write_modes(spark, name):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    tables.create(df, name("t"))
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        tables.create(df, name("t"))
    tables.append(df, name("t"))
    assert tables.table(spark, name("t")).count() == 4
    tables.overwrite(df, name("t"))
    tables.append(df.union(tables.rows(spark, [(3, "c")], "id int, v string")), name("t"), key="id")
    assert tables.table(spark, name("t")).count() == 3
    with pytest.raises(Exception, match="UNSUPPORTED_OVERWRITE"):
        tables.overwrite(spark.read.table(name("t")), name("t"))


# --- catalog -----------------------------------------------------------------------------


def test_catalog_loads(spark, manifest, name):
    catalog.load_master_index(manifest, name("bronze"), name("silver"), "1996")
    assert 0 < spark.read.table(name("silver")).count() < spark.read.table(name("bronze")).count()
    catalog.ingest_prefixes(manifest, name("silver"), name("crawls"))
    crawls = spark.read.table(name("crawls"))
    in_1996 = manifest.where(F.col("crawl_prefix").contains("1996")).count()
    assert crawls.count() == in_1996 and set(crawls.columns) == set(MANIFEST_COLUMNS)
    catalog.backfill(manifest, name("bronze"), name("crawls"), ["1997", "1997", "1996"])
    both = manifest.where(F.col("crawl_prefix").rlike("199[67]")).count()
    assert spark.read.table(name("crawls")).count() == both
    first = catalog.ingest_latest(manifest, name("bronze"), name("crawls"))
    newest = manifest.agg(F.max("crawl_prefix")).first()[0]
    assert first == {"rows": manifest.where(F.col("crawl_prefix") == newest).count(), "duplicate_keys": 0}
    after = spark.read.table(name("crawls")).count()
    assert after == both + first["rows"]
    catalog.ingest_latest(manifest, name("bronze"), name("crawls"))
    assert spark.read.table(name("crawls")).count() == after


def test_sampling_never_repeats(spark, manifest, name):
    tables.overwrite(manifest, name("crawls"))
    for run in (1, 2, 3):
        catalog.sample_to_table(spark, name("crawls"), name("sampled"), ["1995", "1996"], 2)
        sampled = spark.read.table(name("sampled"))
        assert sampled.count() == 4 * run == sampled.select("obj_key").distinct().count()
    assert "checksum_algorithm" not in sampled.columns


# --- silver and gold ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def archive(spark, sf, tmp_path_factory):
    """Archive files with the salted records, one of them gzipped."""
    import gzip

    folder = tmp_path_factory.mktemp("wet")
    texts = [r["value"] for r in record_texts(spark, sf, with_signals=True).orderBy("doc_id").collect()]
    half = len(texts) // 2
    joined = ["".join("WARC/1.0\r\n" + t + "\r\n\r\n" for t in part) for part in (texts[:half], texts[half:])]
    (folder / "a.warc.wet").write_bytes(joined[0].encode())
    (folder / "b.warc.wet.gz").write_bytes(gzip.compress(joined[1].encode()))
    return str(folder)


def test_wet_to_silver_to_gold(spark, sf, archive, name):
    for _ in (1, 2):
        assert silver.wet_to_silver(spark, archive, name("pages"), name("runs")) == 0
    pages = spark.read.table(name("pages"))
    want, summary = silver.silver_pages(parse_all(record_texts(spark, sf, with_signals=True)))
    columns = ["record_id", "target_uri", "content", "lang_status", "row_num"]
    assert sorted(map(tuple, pages.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))
    runs = spark.read.table(name("runs")).collect()
    # the load was repeated: neither its pages nor its summary came twice
    assert len(runs) == 1 and runs[0].asDict() == {**summary.first().asDict(), "load_id": runs[0]["load_id"]}
    assert runs[0]["total_products_found"] == pages.count() and runs[0]["total_english_only"] is None

    counts = {r["label"]: r["n"] for r in gold.enrich_to_gold(spark, name("pages"), name("gold")).collect()}
    assert set(counts) == {"cites", "repackages"}
    gold.save_unigrams(spark, name("gold"), name("unigrams"))
    assert spark.read.table(name("unigrams")).count() == 100
    roles = {"census_product_cleaned": name("pages"), "unigrams_repackaged": name("unigrams")}
    assert set(gold.marts(spark, roles)) == set(roles)
    with pytest.raises(ValueError, match="nothing_here"):
        gold.marts(spark, {"x": "nothing_here"})
    reports_ = gold.domain_reports(spark.read.table(name("gold")))
    assert reports_["tld"].count() >= 1 and reports_["root_url"].count() <= 10


def test_flags_equal_separate_counts(spark, sf):
    records = parse_all(record_texts(spark, sf, with_signals=True))
    _, summary = silver.silver_pages(records, english_only=True)
    flagged = silver.flag_records(records)
    row = summary.first()
    assert row["total_records_processed"] == records.count()
    assert row["total_clean_count"] == flagged.where("clean").count()
    assert row["total_english_records_found"] == flagged.where("kept").count()
    assert 0 < row["total_products_found"] < flagged.where("found").count()


def test_site_presence_lists_absent_sites(spark):
    df = spark.createDataFrame([("https://www.pewresearch.org/a", "cites")], "target_uri string, label string")
    rows = {r["site"]: tuple(r) for r in reports.site_presence(df).collect()}
    assert rows == {
        "urbaninstitute.org": ("urbaninstitute.org", False, 0, 0),
        "pewresearch.org": ("pewresearch.org", True, 1, 0),
    }


def test_site_columns(spark):
    urls = {
        "https://www.a.www.b.org/x?y": ("a.b.org", ".org"),
        "http://u@h.com:80/": ("u@h.com:80", None),
        "//h.co.uk": ("h.co.uk", ".uk"),
        "no scheme": ("", None),
    }
    df = spark.createDataFrame([(u,) for u in urls], "target_uri string")
    got = {r["target_uri"]: (r["root_url"], r["tld"]) for r in reports.with_site_columns(df).collect()}
    assert got == urls


@pytest.mark.parametrize("n", [1, 2, 3])
def test_ngram_totals(spark, n):
    texts = ["one two three four", "one", "", "the one the two", "a b c"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    total = ngrams.term_counts(df, "t", ngram_range=(n, n), stop_words=["the"]).agg(F.sum("frequency")).first()[0]
    sizes = [4, 1, 0, 2, 0]
    assert (total or 0) == sum(max(0, s - n + 1) for s in sizes)


def test_ngrams_span_stop_words(spark):
    df = spark.createDataFrame([("state of the art 007 7",)], "t string")
    terms = ngrams.top_ngrams(df, "t", (2, 2), additional_stop_words=["7"], top_n=5).collect()
    assert sorted(r["term"] for r in terms) == ["art 007", "state art"]
    with pytest.raises(ValueError):
        ngrams.top_ngrams(df, "t", (0, 1))


# --- streams --------------------------------------------------------------------------------


def test_wet_stream_is_incremental(spark, tmp_path, name):
    source = tmp_path / "in"
    source.mkdir()

    def page(i):
        body = f"page {i} cites data.census.gov in a long enough text"
        return (
            f"WARC/1.0\r\nWARC-Type: conversion\r\nWARC-Target-URI: https://h.org/{i}\r\n"
            f"WARC-Record-ID: <urn:uuid:{i}>\r\nContent-Length: {len(body)}\r\n\r\n{body}\r\n\r\n"
        )

    def run():
        ingest.ingest_wet(spark, str(source), name("pages"), str(tmp_path / "cp")).awaitTermination()
        return spark.read.table(name("pages")).count()

    (source / "1.wet").write_bytes((page(1) + page(2) + page(2)).encode())
    assert run() == 2
    (source / "2.wet").write_bytes((page(2) + page(3)).encode())
    assert run() == 3
    assert run() == 3
    assert spark.read.table(name("pages")).where("lang_status is null").count() == 0


def test_batch_and_stream_share_a_table(spark, tmp_path, name):
    """A batch load, a stream over the same and newer files, and a repeated batch load."""
    source = tmp_path / "in"
    source.mkdir()

    def page(i, tail=""):
        body = f"page {i} cites data.census.gov in a long enough text {tail}".strip()
        return (
            f"WARC/1.0\r\nWARC-Type: conversion\r\nWARC-Target-URI: https://h.org/{i}\r\n"
            f"WARC-Record-ID: <urn:uuid:{i}>\r\nContent-Length: {len(body)}\r\n\r\n{body}\r\n\r\n"
        )

    def batch():
        assert silver.wet_to_silver(spark, str(source / "1.wet"), name("pages"), name("runs")) == 0

    def stream():
        ingest.ingest_wet(
            spark, str(source), name("pages"), str(tmp_path / "cp"), summary=name("runs")
        ).awaitTermination()

    (source / "1.wet").write_bytes((page(1) + page(2)).encode())
    batch()
    (source / "2.wet").write_bytes((page(2) + page(3) + page(3, "and more") + page(4)).encode())
    stream()
    batch()
    stream()
    pages = {r["record_id"]: r for r in spark.read.table(name("pages")).collect()}
    assert len(pages) == spark.read.table(name("pages")).count() == 4
    assert pages["<urn:uuid:3>"]["content"].endswith("and more")
    runs = spark.read.table(name("runs"))
    assert runs.count() == runs.select("load_id").distinct().count() == 2


def test_manifest_stream(spark, manifest, tmp_path, name):
    source = tmp_path / "in"
    half = manifest.where("size % 200 = 0")
    half.select(*MANIFEST_COLUMNS).write.mode("append").parquet(str(source))

    def run():
        ingest.ingest_manifest(spark, str(source), name("m"), str(tmp_path / "cp")).awaitTermination()
        return spark.read.table(name("m")).count()

    assert run() == half.count()
    manifest.select(*MANIFEST_COLUMNS).write.mode("append").parquet(str(source))
    assert run() == manifest.count() == spark.read.table(name("m")).select("obj_key").distinct().count()


def test_stream_state_drops_repeats(spark, tmp_path):
    """Repeats in a later run are dropped by the state; keyless and old rows pass; keys are forgotten in time."""
    schema = "obj_key string, last_modified timestamp, size bigint"

    def run(place, rows, remember):
        frame = spark.createDataFrame(rows, "obj_key string, size bigint")
        old = F.lit("1996-01-01").cast("timestamp")  # an old object is not a late row
        frame.select("obj_key", old.alias("last_modified"), "size").write.mode("append").parquet(str(tmp_path / place))
        seen = []
        stream = ingest.first_arrivals(spark.readStream.schema(schema).parquet(str(tmp_path / place)), "obj_key", remember)
        query = (
            stream.writeStream.foreachBatch(lambda batch, _: seen.extend((r.obj_key, r.size) for r in batch.collect()))
            .option("checkpointLocation", str(tmp_path / f"{place}-cp"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return sorted(seen, key=str), query.lastProgress["stateOperators"][0]["numRowsTotal"]

    assert run("kept", [("a", 1), ("b", 2), ("a", 1), (None, 3)], "1 hour") == ([("a", 1), ("b", 2), (None, 3)], 3)
    assert run("kept", [("a", 1), ("c", 4), (None, 5)], "1 hour") == ([("c", 4), (None, 5)], 5)
    sizes = []
    for k in range(4):
        rows, held = run("short", [(f"k{k}", k)], "1 second")
        sizes.append(held)
        assert rows == [(f"k{k}", k)]
        time.sleep(2.5)
    assert max(sizes) <= 2


def test_keyless_rows_are_not_merged(spark, name):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 3)], "k string, v int")
    ingest.append_unseen(name("t"), "k")(df, 0)
    assert spark.read.table(name("t")).count() == 3


# --- plan shapes ---------------------------------------------------------------------------------

PYTHON_QUERIES = {"diacritic_ratio", "lang_model_votes"}


@pytest.mark.parametrize("query", sorted(registry))
def test_plan_shape(spark, sf, plan, query):
    text = plan(registry[query].build(spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if query not in PYTHON_QUERIES:
        assert "EvalPython" not in text and "MapInPandas" not in text


def test_no_row_meets_all_others(spark, sf, plan):
    """A single-partition exchange may only carry aggregated rows."""
    for query in ("silver_pages", "row_numbers", "auc_rank", "wet_parse", "ngrams_by_label"):
        for part in plan(registry[query].build(spark, sf)).split("Exchange SinglePartition")[1:]:
            head = "\n".join(part.splitlines()[1:3])
            assert "HashAggregate" in head, (query, head)


def test_checkpoint_setting_is_used(spark):
    assert spark.conf.get("spark.checkpoint.dir") in checkpoint_dir(spark)


def test_separator():
    assert record_separator() == "\nWARC/1.0\r\n"


def test_pushdown(spark, sf, plan):
    text = plan(corpus(spark, sf).select("target_uri"))
    assert "html" not in text


def test_no_scan_is_redistributed(spark, sf, plan):
    for query in ("lang_english_only", "keyword_subject", "min_length_filter"):
        assert "REPARTITION" not in plan(registry[query].build(spark, sf))


def test_shuffles_carry_no_more_than_they_need(spark, sf, plan):
    assert plan(registry["running_record_id"].build(spark, sf)).count("Exchange") == 1
    for query in ("similar_pages", "longest_per_uri"):
        for line in plan(registry[query].build(spark, sf)).splitlines():
            assert "Exchange" not in line or ("content" not in line and "text_norm" not in line)
    assert "Generate" not in plan(registry["cosine_terms_to_anchor"].build(spark, sf))


def test_similar_pages_are_labelled_once(spark, sf, plan):
    """The anchor's URI, its page and the other pages are read from the stored labelled pages."""
    assert "FileScan" not in plan(registry["similar_pages"].build(spark, sf))


def test_fixtures_hold_what_the_operators_act_on(spark, sf):
    """Each of these operators changes rows of the fixtures."""
    pages = reports.with_site_columns(corpus(spark, sf))
    assert 0 < pages.where("root_url = 'census.gov'").count() < pages.count()
    assert 0 < pages.where("tld is null").count() < pages.count()
    labelled = signals.label_pages(corpus(spark, sf))
    assert gold.outside_publisher(labelled).where("label is not null").count() < labelled.where("label is not null").count()
    flags = {r[0] for r in registry["nonlatin_flag"].build(spark, sf).select("non_latin").distinct().collect()}
    assert flags == {True, False}
    tops = {r[0] for r in registry["lang_debug"].build(spark, sf).select("top_noneng_label").distinct().collect()}
    assert tops == {"", "non_latin"}
    assert registry["duplicate_objects"].build(spark, sf).first()[0] > 0


def test_no_size_switches():
    package = Path(__file__).resolve().parent.parent / "crawlprism"
    for folder in ("operators", "plans", "sources", "streaming", "functions", "registry"):
        for file in (package / folder).glob("*.py"):
            text = file.read_text()
            assert ".coalesce(" not in text.replace("F.coalesce(", "") and ".take(" not in text and "_jdf" not in text, file
