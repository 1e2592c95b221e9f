"""Session settings and the two cluster-level helpers every operator shares."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # what one Arrow batch holds in a Python worker
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 * 1024 * 1024),
    # the keys a stream remembers lie on local disk and in its checkpoint, not in the heap
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Settings that only count before the session starts: checkpoints go when nothing refers to them.
STARTUP_SETTINGS = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}

# Rows of one sorted partition stay near this size.
PARTITION_BYTES = 256 * 1024 * 1024


def build_session(
    app: str = "crawlprism",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **STARTUP_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for lineage cuts: the session's setting, or a scratch folder on a local master only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    active = spark.sparkContext.getCheckpointDir()
    if active:
        return active
    if configured is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="crawlprism-checkpoints-")
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of any executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def width_for(df: DataFrame, target_bytes: int = PARTITION_BYTES) -> int:
    """Shuffle partitions that hold about ``target_bytes`` each, but no fewer than the session sets.

    Reads the frame once for one number, so give it a stored frame.
    """
    widths = [
        F.coalesce(F.octet_length(f.name), F.lit(0)) if f.dataType.simpleString() == "string" else F.lit(8)
        for f in df.schema.fields
    ]
    total = df.agg(F.sum(sum(widths, F.lit(16)).cast("bigint"))).first()[0] or 0
    return max(shuffle_width(df.sparkSession), -(-total // target_bytes))
