"""Incremental loads: file streams that run to the end of the new files and stop.

Each batch is a load of its own. Duplicates are checked against the target table inside
each batch; a batch that is replayed after a failure finds its rows already there. A
catalog stream may also remember recent keys in its state, which keeps most repeats from
that check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crawlprism.operators.sampling import first_per_group
from crawlprism.plans.silver import append_load
from crawlprism.schemas import MANIFEST_SCHEMA
from crawlprism.sources import tables
from crawlprism.sources.wet import parse_all, record_stream


def append_unseen(table: str, key: str, session: SparkSession | None = None) -> Callable[[DataFrame, int], None]:
    """Batch writer. Batches run in a clone of the session, so ``session`` is told of the new files."""

    def write(batch: DataFrame, _: int) -> None:
        # rows without a key are no duplicates of each other
        keyless = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
        fresh = batch.withColumn("_keyless", keyless).dropDuplicates([key, "_keyless"]).drop("_keyless")
        tables.append(fresh, table, key)
        if session is not None:
            session.catalog.refreshTable(table)

    return write


def first_arrivals(stream: DataFrame, key: str, remember: str) -> DataFrame:
    """Without the rows whose key came before, within ``remember`` of its first arrival.

    Time is that of arrival, so no row is late and none is lost; keys are forgotten with it, which bounds the state. A key that was
    forgotten passes. Rows without a key all pass.
    """
    keyless = F.when(F.col(key).isNull(), F.expr("uuid()"))
    timed = stream.withColumn("_keyless", keyless).withColumn("_arrived", F.current_timestamp())
    return timed.withWatermark("_arrived", remember).dropDuplicatesWithinWatermark([key, "_keyless"]).drop("_keyless", "_arrived")


def _run(stream: DataFrame, table: str, key: str, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(append_unseen(table, key, stream.sparkSession))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _longest_of_each(records: DataFrame) -> DataFrame:
    """Of parsed records that share an id the longest, then the latest; records without an id all stay."""
    keyless = F.when(F.col("record_id").isNull(), F.monotonically_increasing_id())
    order = [F.desc(F.length("content")), F.desc("warc_date"), F.col("content")]
    return first_per_group(records.withColumn("_keyless", keyless), ["record_id", "_keyless"], order).drop("_keyless")


def ingest_wet(
    spark: SparkSession,
    source: str,
    table: str,
    checkpoint: str,
    newline: str = "\r\n",
    summary: str | None = None,
    max_files_per_batch: int | None = None,
    **kwargs,
) -> StreamingQuery:
    """New archive files to the page table, by the same load as the batch form, with a summary row for each batch.

    Row numbers count within a batch, as they count within a batch load. A batch that is replayed
    after a failure adds neither pages nor a second summary.
    """
    options = {"maxFilesPerTrigger": str(max_files_per_batch)} if max_files_per_batch else {}
    records = parse_all(record_stream(spark, source, newline, **options))

    def write(batch: DataFrame, number: int) -> None:
        append_load(_longest_of_each(batch), table, summary, f"{checkpoint}:{number}", **kwargs)
        for name in (table, summary):
            if name is not None:
                spark.catalog.refreshTable(name)

    return (
        records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def ingest_manifest(
    spark: SparkSession,
    source: str,
    table: str,
    checkpoint: str,
    file_format: str = "parquet",
    schema: str = MANIFEST_SCHEMA,
    remember: str | None = None,
) -> StreamingQuery:
    """New listing files to the crawl table, unseen keys only.

    With ``remember`` (such as ``7 days``) keys listed again within that time are dropped by the stream's state, and the table is asked
    for the others alone. It is fixed for the life of a checkpoint.
    """
    listing = spark.readStream.format(file_format).schema(schema).load(source)
    if remember is not None:
        listing = first_arrivals(listing, "obj_key", remember)
    return _run(listing, table, "obj_key", checkpoint)
