"""Even assignment of records to log partitions."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offsetledger.session import stored

# monotonically_increasing_id keeps the row's position within its task in the low 33 bits.
_POSITION_BITS = (1 << 33) - 1

# Rows that one task numbers.
ROWS_PER_SLICE = 2_000_000
# Batches whose counts are kept; a replay needs those of the batch before.
KEPT_BATCHES = 100

STARTS = "batch_id long, start long, rows long"


def assign_round_robin(
    df: DataFrame, partitions: int, order_by: str | None = None, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Add `partition`, going round 0..partitions-1.

    Without `order_by` every task goes round with its own rows, from its own number on, so no
    row moves and tasks of few rows do not all begin alike; sizes differ by at most one per
    task. With `order_by` the count runs through the whole frame in that order; equal values keep the order they are
    read in. A stream's plan has no place to count: there each row goes where its hash says, evenly up to chance, and
    `round_robin_batches` counts exactly, batch by batch.
    """
    if df.isStreaming:
        if order_by is not None:
            raise ValueError("a stream has no order to number; leave order_by out")
        place = F.xxhash64(*df.columns, F.rand(), F.lit("place"))
        return df.withColumn("partition", F.pmod(place, F.lit(partitions)).cast("int"))
    if order_by is None:
        position = _place_in_task() + F.spark_partition_id()
        return df.withColumn("partition", (position % partitions).cast("int"))
    numbered = dense_position(df, order_by, rows_per_slice)
    return numbered.withColumn("partition", (F.col("_position") % partitions).cast("int")).drop("_position")


def _place_in_task() -> Column:
    return F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS))


def dense_position(df: DataFrame, order_by: str, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Add `_position`, 0..n-1 in the order of a column of any sortable type, without one global sort task.

    Rows are dealt by ranges of the column, ties by where they were read, so that a value that most rows have is
    split like any other; each task sorts and numbers its range. What they numbered is written, since the ranges
    come from a sample and must be the same for the counts as for the rows; the ranges' first positions are then a
    sum over as many rows as there are ranges. Nulls come last.
    """
    least = df.sparkSession.sparkContext.defaultParallelism
    slices = max(least, 2, math.ceil(df.count() / rows_per_slice))
    order = (F.col(order_by).asc_nulls_last(), F.col("_tie").asc())
    ranged = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange(slices, *order).sortWithinPartitions(*order).drop("_tie")
    return _with_position(stored(ranged.withColumns({"_slice": F.spark_partition_id(), "_place": _place_in_task()}), "numbered"), df)


def dense_unordered(df: DataFrame, start: int = 0) -> DataFrame:
    """Add `_position`, `start` and on without a gap, in whatever order the rows are read.

    `df` must give the same rows in the same tasks again, as a stored or cached frame does.
    """
    return _with_position(df.withColumns({"_slice": F.spark_partition_id(), "_place": _place_in_task()}), df, start)


def _with_position(numbered: DataFrame, df: DataFrame, start: int = 0) -> DataFrame:
    # A row for each task: the window and the broadcast stay that small.
    sizes = numbered.groupBy("_slice").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_slice", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    placed = numbered.join(F.broadcast(starts), "_slice")
    return placed.select(*df.columns, (F.lit(start) + F.col("_start") + F.col("_place")).cast("long").alias("_position"))


def round_robin_batches(
    sink: Callable[[DataFrame, int], None], partitions: int, state: str
) -> Callable[[DataFrame, int], None]:
    """For `foreachBatch`: hand each batch on to `sink` with `partition`, going round through the whole stream.

    The count goes on from batch to batch, so the partitions' sizes differ by at most one, whatever the batches are.
    Where a batch starts is kept in the shared folder `state` by batch id before the sink sees it, and follows from
    the batch before: a batch that is replayed starts where it did, and one that failed counts once.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            start, rows = _start_of(spark, state, batch_id), batch.count()
            entry = spark.createDataFrame([(batch_id, start, rows)], STARTS)
            entry.coalesce(1).write.mode("overwrite").parquet(f"{state}/{batch_id % KEPT_BATCHES:03d}")
            placed = dense_unordered(batch, start)
            sink(placed.withColumn("partition", (F.col("_position") % partitions).cast("int")).drop("_position"), batch_id)
        finally:
            batch.unpersist()

    return process


def _start_of(spark: SparkSession, state: str, batch_id: int) -> int:
    """Rows of all batches before this one: a few small files, one for each batch kept."""
    try:
        kept = spark.read.schema(STARTS).option("recursiveFileLookup", True).parquet(state)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    last = kept.filter(F.col("batch_id") < batch_id).agg(F.max_by(F.col("start") + F.col("rows"), "batch_id")).first()[0]
    return last or 0
