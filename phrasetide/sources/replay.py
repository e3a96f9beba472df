"""Paced replay: messages cut into slices that are published one after the other."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phrasetide.session import shared_dir

# Fixed value: messages sent between two pauses.
SLICE_MESSAGES = 1250

# Slices of one turn of a replay without pauses, at most; a turn is one file.
TURN_SLICES = 500


def number_rows(df: DataFrame, order: list[str], column: str = "n") -> DataFrame:
    """Number rows 1, 2, 3, ... in ``order`` without sorting them in one task.

    Rows are range-partitioned and sorted within partitions; the partitions'
    row counts then give each its first number. The sorted rows are
    checkpointed in between: a second run of the sort, after a lost executor
    say, could cut the ranges elsewhere.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    # The id's upper bits are the partition, its lower 33 bits the row in it.
    placed = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_id", F.monotonically_increasing_id())
              .checkpoint())
    part = F.shiftright("_id", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    # One row per partition: the only window in one task, over very few rows.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    in_part = F.col("_id") - F.shiftleft(F.col("_part"), 33)
    return (placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
            .withColumn(column, F.col("_start") + in_part + 1)
            .drop("_id", "_part", "_start"))


def slices(messages: DataFrame, order: list[str], per_slice: int = SLICE_MESSAGES) -> DataFrame:
    """Messages with their ``slice_id``.

    A pause comes whenever a counter that starts at 1 and is raised before it
    is looked at reaches a multiple of ``per_slice``; the first slice is
    therefore one message short.
    """
    return (number_rows(messages, order, "_n")
            .withColumn("slice_id", F.floor(F.col("_n") / per_slice).cast("bigint"))
            .drop("_n"))


def write_slices(sliced: DataFrame, path: str) -> None:
    """Store messages as topic values with their ``slice_id``, in order.

    A file holds a run of slices, sorted, so that one slice is read from few
    row groups; there is no folder or file per slice.
    """
    message = F.struct(*[c for c in sliced.columns if c != "slice_id"])
    value = F.to_json(message, {
        "ignoreNullFields": "false",  # and times to the microsecond
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("value")
    (sliced.select("slice_id", value)
     .repartitionByRange("slice_id").sortWithinPartitions("slice_id")
     .write.parquet(path))


def read_slice(spark: SparkSession, path: str, slice_id: int, slices: int = 1) -> DataFrame:
    """The values of one slice, or of ``slices`` from it on."""
    stored = spark.read.schema("slice_id bigint, value string").parquet(path)
    return stored.filter((F.col("slice_id") >= slice_id)
                         & (F.col("slice_id") < slice_id + slices)).select("value")


def turn_slices(spark: SparkSession, path: str) -> int:
    """Slices a turn of a replay without pauses: an eighth of them, at most ``TURN_SLICES``.

    A turn costs a job and a micro-batch, however small it is, so their number
    must not follow that of the slices.
    """
    last = spark.read.schema("slice_id bigint").parquet(path).agg(F.max("slice_id")).first()[0]
    return min(TURN_SLICES, 1 + (last or 0) // 8)


def replay(spark: SparkSession, path: str, topic, pause: float = 1.0, first: int = 0,
           slices: int = 1) -> int:
    """Publish the stored slices, ``slices`` a turn, turns ``pause`` seconds apart.

    A turn is published whole before the next one starts, so a stream that
    reads ``topic`` meets them in order; on a folder topic each is one file,
    and with ``files_per_batch=1`` one micro-batch. Returns the number after the
    last slice, from which a later replay can go on.
    """
    stored = spark.read.schema("slice_id bigint, value string").parquet(path)
    last = stored.agg(F.max("slice_id")).first()[0]
    for slice_id in range(first, -1 if last is None else last + 1, slices):
        topic.publish(read_slice(spark, path, slice_id, slices).coalesce(1))
        if slice_id + slices <= last:
            time.sleep(pause)
    return first if last is None else max(first, last + 1)


def slice_sizes(sliced: DataFrame) -> DataFrame:
    """Messages sent per slice."""
    return sliced.groupBy("slice_id").agg(F.count("*").alias("n"))
