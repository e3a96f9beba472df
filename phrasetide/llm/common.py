"""What the corpus operators share: tables, written intermediates, ordered buckets."""

from __future__ import annotations

import os
import shutil
import tempfile
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import phrasetide
from phrasetide.session import new_work_dir

# ASCII white space, the separators of words in every operator here.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_BYTES = b" \t\n\x0b\x0c\r"

# Rows go to Python in batches of about this size, whatever their number: both a
# worker and the executor's Arrow buffers hold a few batches at a time.
BATCH_BYTES = "8m"

# A side of a join is broadcast only when its measured payload is below this.
SMALL_BYTES = 8 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session is told to send rows to Python by ``BATCH_BYTES``."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df


def texts_of(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of ``docs``, a null text as the empty one."""
    return small_batches(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``df`` written to the shared folder, with the writer's ``options``, and read back.

    The plan behind it is cut: a lost executor costs the tasks that were running
    on it, not what is already written.
    """
    path = new_work_dir(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def without(docs: DataFrame, dropped: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose ``key`` is not in ``dropped`` (one column).

    All columns of ``docs`` are kept whatever their names. ``dropped`` is
    broadcast when its counted size allows, else both sides are shuffled by key.
    """
    ids = dropped.toDF("dropped_key")
    if ids.count() * 16 <= SMALL_BYTES:
        ids = F.broadcast(ids)
    return docs.join(ids, docs[key] == ids["dropped_key"], "left_anti")


def up_to(key: Column, borders: list[int]) -> Column:
    """How many of the sorted ``borders`` are at most ``key``; 0 for a null key.

    A binary search over a literal array that is folded once: whole numbers are
    compared as such, so no key of 64 bits is rounded or overflows.
    """
    if not borders:
        return F.lit(0)
    table = F.split(F.lit(",".join(map(str, borders))), ",").cast("array<bigint>")
    steps = [1 << n for n in reversed(range(len(borders).bit_length()))]
    return F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda at, step: F.when(F.get(table, at + step - 1) <= key, at + step).otherwise(at))


class Buckets:
    """Consecutive ranges of an integer key, each to be handled by one task.

    The span of the keys is cut into cells and the rows of each are counted;
    cells that hold over half a bucket are cut again between their least and
    largest key, until they hold less or one key. Runs of cells make buckets of
    about equal row counts, so neither a far key nor a dense source fills one.
    Only cells come to the driver: ``CELLS`` or eight per bucket at a time,
    whatever the table's size. With ``weight`` its sums are counted, not rows.

    ``count`` says how many buckets there are, each with rows, and ``first``
    gives the least key of each. Rows without a key lie in the first one, before
    all others: its ``first`` is then None.
    """

    CELLS = 16384

    def __init__(self, df: DataFrame, key: str, count: int, weight: Column | None = None):
        rows = df.select(F.col(key).cast("bigint").alias("key"),
                         (F.lit(1) if weight is None else weight).cast("bigint").alias("weight"))
        low, high, keys, every = rows.agg(F.min("key"), F.max("key"), F.count("key"),
                                          F.count("*")).first()
        cells = self._cells(rows, low, high, count) if keys else []
        total, done, bucket = sum(n for _, _, n in cells), 0, -1
        self.borders: list[int] = []
        for first, _, n in cells:
            if (at := done * count // max(total, 1)) > bucket:
                bucket = at
                self.borders.append(first)
            done += n
        self.key, self.count = key, max(1, len(self.borders))
        self.first: dict[int, int | None] = dict(enumerate(self.borders))
        if every > keys:
            self.first[0] = None

    def _cells(self, rows: DataFrame, low: int, high: int, count: int) -> list[tuple]:
        """Least key, largest key and weight of every cell that has rows."""
        most, done, heavy = None, [], [(low, high)]
        while heavy:
            each = max(2, max(self.CELLS, 4 * count) // len(heavy))
            starts, ends = [], []
            for low, high in heavy:
                width = -(-(high - low + 1) // each)
                starts += range(low, high + 1, width)
                ends += [*range(low + width - 1, high, width), high]
            at = up_to(F.col("key"), starts) - 1
            last = F.split(F.lit(",".join(map(str, ends))), ",").cast("array<bigint>")
            found = (rows.withColumn("cell", at).filter(F.col("key") <= F.get(last, "cell"))
                     .groupBy("cell").agg(F.min("key"), F.max("key"), F.sum("weight")).collect())
            if most is None:
                most = sum(n for *_, n in found) // (2 * count)
            heavy = sorted((low, high) for _, low, high, n in found if n > most and low < high)
            done += [(low, high, n) for _, low, high, n in found if n <= most or low == high]
        return sorted(done)

    def column(self) -> Column:
        """The bucket of a row."""
        return up_to(F.col(self.key), self.borders[1:])


@cache
def _shipped(application: str) -> str:
    folder = tempfile.mkdtemp(prefix="phrasetide-code-")
    root = os.path.dirname(os.path.dirname(os.path.abspath(phrasetide.__file__)))
    return shutil.make_archive(f"{folder}/phrasetide_code", "zip", root, "phrasetide")


def ship_code(spark: SparkSession) -> SparkSession:
    """Send this package to the executors' Python, once per application."""
    context = spark.sparkContext
    seen = _shipped.cache_info().currsize
    path = _shipped(context.applicationId)
    if _shipped.cache_info().currsize > seen:
        context.addPyFile(path)
    return spark
