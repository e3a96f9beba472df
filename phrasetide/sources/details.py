"""Details of posts, to be looked up by id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Share of row groups that are read although they don't hold an id.
FALSE_POSITIVES = 0.01
# Bytes of a row group: what one found id costs to read.
GROUP_BYTES = 8 * 1024 * 1024


def write_details(rows: DataFrame, path: str, key: str = "doc_id",
                  group_bytes: int = GROUP_BYTES, group_rows: int = 100_000,
                  mode: str = "append") -> None:
    """Store ``rows`` with a Bloom filter of ``key`` in every row group.

    Rows stay in the files that they arrive in, whatever ids those hold: nothing
    is shuffled or sorted, and later batches are appended. ``group_rows`` is how
    many ids a filter is made for; it takes ten bits or so for each.
    """
    (rows.write.mode(mode)
     .option(f"parquet.bloom.filter.enabled#{key}", "true")
     .option(f"parquet.bloom.filter.expected.ndv#{key}", group_rows)
     .option(f"parquet.bloom.filter.fpp#{key}", FALSE_POSITIVES)
     .option(f"parquet.enable.dictionary#{key}", "false")
     .option("parquet.block.size", group_bytes)
     .option("parquet.block.row.count.limit", group_rows)
     .parquet(path))


def read_details(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The stored rows, which have the columns of ``like``."""
    return spark.read.schema(like.schema).parquet(path)
