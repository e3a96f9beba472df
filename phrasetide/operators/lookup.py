"""Joins of a large side with one that is usually, but not surely, small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only when its measured payload is below this many bytes.
BROADCAST_BYTES = 128 * 1024 * 1024

# Pieces every key is split into when both sides have to be shuffled. The small
# side is sent this many times, so it is kept low; a piece that is still too
# large for a task is split further by adaptive skew handling.
SALTS = 8

# Room for a row's header, null bits and fixed-width words.
_ROW_BYTES = 64


def _payload(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0))
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(column)), F.lit(0))
    return F.lit(8)


def row_bytes(df: DataFrame) -> Column:
    """Approximate size of one row of ``df``."""
    total = F.lit(_ROW_BYTES).cast("bigint")
    for field in df.schema:
        total = total + _payload(field)
    return total


def measured_bytes(df: DataFrame) -> int:
    """Size of ``df``, found by one aggregate over it."""
    return df.agg(F.sum(row_bytes(df))).first()[0] or 0


def salted(big: DataFrame, small: DataFrame, salt_by: list[str],
           salts: int = SALTS) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``_salt`` column that spreads each key over ``salts``.

    The salt of a large-side row is a hash of ``salt_by``, never a random
    number: a task repeated after a lost executor must place its rows alike.
    """
    big = big.withColumn(
        "_salt", F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int"))
    small = small.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return big, small


def lookup_join(big: DataFrame, small: DataFrame, on: list[str], how: str,
                salt_by: list[str], limit: int = BROADCAST_BYTES,
                small_bytes: int | None = None) -> DataFrame:
    """Join ``big`` with ``small``, whichever size ``small`` turns out to have.

    The size is measured unless the caller has a bound for it (``small_bytes``).

    Below ``limit`` the small side is broadcast and ``big`` is not shuffled.
    Beyond it both are shuffled with salted keys, so that one key holding a
    third of ``big`` is spread over many tasks. ``how`` is ``inner``, ``left``,
    ``left_semi`` or ``left_anti``; every large-side row meets all rows of its
    key under its one salt, so the result is the same either way.
    """
    if small_bytes is None:
        small_bytes = measured_bytes(small)
    if small_bytes <= limit:
        return big.join(F.broadcast(small), on, how)
    big, small = salted(big, small, salt_by)
    return big.join(small, [*on, "_salt"], how).drop("_salt")


# Bits of a bitmap per key: one other key in nine passes it.
KEY_BITS = 8


def marked_by_bitmap(rows: DataFrame, keys: DataFrame, on: list[str], column: str,
                     limit: int = BROADCAST_BYTES) -> DataFrame:
    """``rows`` with the boolean ``column``: false only where ``keys`` lack the row's key.

    A bitmap of the keys' hashes is broadcast, ``KEY_BITS`` for each key as far as
    ``limit`` bytes go, so that rows it rules out need no shuffle. Rows whose key
    has a null are false.
    """
    count = keys.count()
    bits = max(1 << 15, min(1 << (KEY_BITS * count).bit_length(), 1 << (4 * limit).bit_length()))
    place = F.pmod(F.xxhash64(*on), F.lit(bits))
    blocks = (keys.groupBy(F.bitmap_bucket_number(place).alias("_block"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits")))
    byte = F.conv(F.hex(F.substring("_bits", (F.col("_at") / 8).cast("int") + 1, F.lit(1))), 16, 10)
    found = F.getbit(byte.cast("int"), F.pmod("_at", F.lit(8)).cast("int")) == 1
    for c in on:
        found = found & F.col(c).isNotNull()
    return (rows.withColumns({"_block": F.bitmap_bucket_number(place),
                              "_at": F.bitmap_bit_position(place)})
            .join(F.broadcast(blocks), "_block", "left")
            .withColumn(column, F.coalesce(found, F.lit(False))).drop("_block", "_at", "_bits"))


# Values of one pushed-down list; Spark turns longer ones into a range of values.
_LIST = 10


def among(column: str, values: Sequence) -> Column:
    """Whether ``column`` has one of ``values``, as lists that reach the Parquet reader.

    Each list is tested there against a row group's statistics and Bloom filter.
    """
    found = F.lit(False)
    for at in range(0, len(values), _LIST):
        found = found | F.col(column).isin(list(values[at:at + _LIST]))
    return found
