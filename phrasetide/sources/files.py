"""Files of newline-delimited text, and scans of few files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every line of every file under ``path``, subfolders included, as ``line``."""
    return (spark.read.option("recursiveFileLookup", "true").text(path)
            .withColumnRenamed("value", "line"))


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of files as they arrive, also in subfolders, ``files_per_batch`` files at a time."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path).withColumnRenamed("value", "line")


def spread(scan: DataFrame) -> DataFrame:
    """Spread the rows of a plain scan over all cores when it has fewer tasks than cores.

    A Parquet row group is read by one task, so a table of one file would be
    tokenised on one core. Larger tables are returned as they are, unshuffled.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
