"""Global numbering and running totals without a single-task window.

Rows are range-partitioned by the ordering and sorted inside each partition. The
only global step runs over one total per partition. The sorted rows are
checkpointed before positions are read from them, so a lost executor cannot
change the partition boundaries between the two passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlprism.session import cut_lineage, shuffle_width

# monotonically_increasing_id() = partition number << 33 | position in the partition
_POSITION_BITS = 33
_POSITION_MASK = (1 << _POSITION_BITS) - 1


def _range_sorted(df: DataFrame, order_by: list[str], partitions: int | None) -> DataFrame:
    width = partitions or shuffle_width(df.sparkSession)
    return cut_lineage(df.repartitionByRange(width, *order_by).sortWithinPartitions(*order_by))


def _before(totals: DataFrame, part: str, columns: list[str]) -> DataFrame:
    """Sum over the lower partitions. ``totals`` has one row per partition, which bounds the broadcast."""
    lower = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(
        totals.select(
            part, *[F.coalesce(F.sum(c).over(lower), F.lit(0)).alias(f"_before_{c}") for c in columns]
        )
    )


def with_row_number(
    df: DataFrame, order_by: list[str], out_col: str = "row_num", partitions: int | None = None
) -> DataFrame:
    """``row_number() over (order by ...)`` for frames of any size.

    ``partitions`` defaults to the session's shuffle partitions; ``session.width_for`` measures
    a stored frame for it.

    Rows that tie on ``order_by`` are spread by their input partition, so one key that
    holds a third of the rows does not make one task, and a repeated task sends its
    rows to the same place. Numbers among such ties are arbitrary but unique.
    """
    spread = df.withColumn("_tie", F.spark_partition_id())
    located = _range_sorted(spread, [*order_by, "_tie"], partitions).withColumn(
        "_loc", F.monotonically_increasing_id()
    )
    located = located.withColumn("_part", F.shiftright("_loc", _POSITION_BITS))
    totals = located.groupBy("_part").agg(F.count(F.lit(1)).alias("rows"))
    return (
        located.join(_before(totals, "_part", ["rows"]), "_part")
        .withColumn(
            out_col, F.col("_before_rows") + F.col("_loc").bitwiseAND(F.lit(_POSITION_MASK)) + 1
        )
        .drop("_part", "_loc", "_tie", "_before_rows")
    )


def _totals_within(df: DataFrame, totals: dict[str, str]) -> DataFrame:
    """Running totals of each partition on its own, in the order of its rows, without a shuffle."""
    kinds = {out: "double" if isinstance(df.schema[v].dataType, T.FractionalType) else "bigint" for out, v in totals.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        so_far = dict.fromkeys(totals, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            columns, names = list(batch.columns), list(batch.schema.names)
            for out, value in totals.items():
                numbers = batch.column(names.index(value)).cast(pa.float64() if kinds[out] == "double" else pa.int64())
                running = pc.cumulative_sum(pc.fill_null(numbers, 0), start=so_far[out])
                so_far[out] = running[-1].as_py()
                columns.append(running)
            yield pa.RecordBatch.from_arrays(columns, [*names, *totals])

    added = T.StructType([T.StructField(out, T.DoubleType() if kind == "double" else T.LongType()) for out, kind in kinds.items()])
    return df.mapInArrow(run, T.StructType([*df.schema.fields, *added.fields]))


def with_running_totals(
    df: DataFrame, order_by: list[str], totals: dict[str, str], partitions: int | None = None
) -> DataFrame:
    """``sum(value) over (order by ... rows unbounded preceding)`` for each ``{out_col: value_col}``.

    ``order_by`` must be unique per row: ties would have to share a partition. NULL counts as 0; whole numbers have
    whole totals, others doubles. The rows are shuffled once, by range: each partition, sorted as it is, adds up its own rows, and
    the totals of the lower partitions are added to that.
    """
    sorted_rows = _range_sorted(df, order_by, partitions).withColumn("_part", F.spark_partition_id())
    values = list(dict.fromkeys(totals.values()))
    per_part = sorted_rows.groupBy("_part").agg(*[F.sum(v).alias(v) for v in values])
    return (
        _totals_within(sorted_rows, totals)
        .join(_before(per_part, "_part", values), "_part")
        .withColumns({out: F.col(out) + F.col(f"_before_{v}") for out, v in totals.items()})
        .drop("_part", *[f"_before_{v}" for v in values])
    )


def number_records(
    lines: DataFrame,
    order_by: list[str],
    line_col: str = "value",
    marker: str = "WARC/1.0",
    out_col: str = "record_no",
    file_col: str | None = None,
) -> DataFrame:
    """Record number of each line: how many marker lines stand at or before it.

    With ``file_col`` records are numbered within their file, which takes one shuffle and no
    global order; a file is then one window. Without it the numbers run over all lines.
    """
    marked = lines.withColumn("_start", F.when(F.col(line_col) == marker, 1).otherwise(0))
    if file_col is not None:
        inside = Window.partitionBy(file_col).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return marked.withColumn(out_col, F.sum("_start").over(inside)).drop("_start")
    return with_running_totals(marked, order_by, {out_col: "_start"}).drop("_start")


def join_lines(
    numbered: DataFrame,
    order_by: list[str],
    line_col: str = "value",
    record_col: str = "record_no",
    file_col: str | None = None,
) -> DataFrame:
    """Lines of one record joined in order; empty records dropped.

    Only for line-level input: the record scan reads whole records directly.
    Record 0 (lines before the first marker) can be a whole unmarked file and never
    parses to a record, so it is dropped before grouping.
    """
    pieces = F.array_sort(F.collect_list(F.struct(*order_by, line_col)))
    return (
        numbered.where(F.col(record_col) > 0)
        .groupBy(*([file_col] if file_col else []), record_col)
        .agg(F.concat_ws("\n", F.transform(pieces, lambda p: p[line_col])).alias("record_text"))
        .where(F.col("record_text") != "")
    )
