"""Sharding over fixed virtual slots.

Records are hashed into thousands of slots that never change. Bytes are summed
per slot, and a stored, versioned map says which shard holds a slot. Version 0
deals slots in turn; each rebalancing writes a new version that moves as few
slots as it can. Only the map, at most one row per slot, is ever broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phrasetide.llm.common import written

SLOTS = 8192


def slot_of(key: str = "doc_id", slots: int = SLOTS) -> Column:
    """The virtual slot of a record; a null key has a slot like any other."""
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def text_size(text: str = "text") -> Column:
    """UTF-8 bytes of a text (null: none) and one for the record."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def slot_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text",
               slots: int = SLOTS) -> DataFrame:
    """Rows ``n`` and ``bytes`` of every slot, empty slots included; counted once."""
    used = (docs.select(slot_of(key, slots).alias("virtual_slot"), text_size(text).alias("bytes"))
            .groupBy("virtual_slot").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")))
    every = docs.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return written(every.join(used, "virtual_slot", "left").fillna(0, ["n", "bytes"]),
                   "slot-bytes")


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 0 of the map: slots dealt to the shards in turn."""
    slot = F.col("id").cast("int")
    return spark.range(slots).select(F.lit(0).alias("version"), slot.alias("virtual_slot"),
                                     (slot % shards).alias("shard"))


def rebalanced(current: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The next version of the map ``current``, by the bytes of ``sizes``.

    A shard keeps its empty slots, and its largest ones as long as they fit an
    equal share; the others, and all slots of shards that are no more, go one by one, the largest
    first, to the shard that holds least. With more shards than before, slots
    move only out of overfull shards.
    """
    known = current.join(sizes, "virtual_slot")
    share = sizes.agg(F.sum("bytes") / shards).scalar()
    largest_first = Window.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot")
    marked = (known.withColumn("upto", F.sum("bytes").over(largest_first))
              .withColumn("stays", (F.col("shard") < shards)
                          & ((F.col("upto") <= share) | (F.col("bytes") == 0))))
    marked = written(marked, "slots-marked")  # one row per slot, read four times
    numbers = known.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    held = (numbers.join(marked.filter("stays").groupBy("shard").agg(F.sum("bytes").alias("b")),
                         "shard", "left")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct(
                "shard", F.coalesce("b", F.lit(0)).alias("b")))), lambda s: s["b"])).scalar())
    # At most one entry per slot: the array is bounded by the number of slots.
    pool = (marked.filter(~F.col("stays"))
            .agg(F.reverse(F.array_sort(F.collect_list(
                F.struct("bytes", "virtual_slot")))).alias("pool")))
    start = F.struct(F.col("held").alias("loads"),
                     F.array().cast("array<struct<virtual_slot:int,shard:int>>").alias("moves"))

    def deal(acc: Column, slot: Column) -> Column:
        least = F.array_position(acc["loads"], F.array_min(acc["loads"])).cast("int") - 1
        loads = F.transform(acc["loads"], lambda load, i: F.when(
            i == least, load + slot["bytes"]).otherwise(load))
        move = F.struct(slot["virtual_slot"].alias("virtual_slot"), least.alias("shard"))
        return F.struct(loads.alias("loads"), F.concat(acc["moves"], F.array(move)).alias("moves"))

    dealt = (pool.withColumn("held", F.lit(held).cast("array<bigint>"))
             .select(F.inline(F.aggregate("pool", start, deal, lambda acc: acc["moves"]))))
    version = (F.col("version") + 1).alias("version")
    kept = marked.filter("stays").select(version, "virtual_slot", "shard")
    moved = (marked.filter(~F.col("stays")).select("version", "virtual_slot")
             .join(dealt, "virtual_slot").select(version, "virtual_slot", "shard"))
    return kept.unionByName(moved)


def write_map(slot_map: DataFrame, path: str) -> None:
    """Add one version to the stored map; older versions stay."""
    slot_map.coalesce(1).write.partitionBy("version").mode("append").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the stored map, the newest by default."""
    every = spark.read.schema("version int, virtual_slot int, shard int").parquet(path)
    if version is None:
        version = every.agg(F.max("version")).scalar()
    return every.filter(F.col("version") == F.lit(version))


def place(docs: DataFrame, slot_map: DataFrame, sizes: DataFrame, key: str = "doc_id",
          slots: int = SLOTS) -> DataFrame:
    """Struct ``record`` (all columns of ``docs``), its ``virtual_slot``, ``shard`` and ``slot``.

    ``slot`` is the record's place in its shard, counted from 0 without gaps: by
    virtual slot, then key. Rows of a shard need not meet: each virtual slot
    starts where the counts of those before it end. Equal keys go to one shard,
    in the order of a hash of their whole rows.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = (slot_map.join(sizes, "virtual_slot")
              .select("virtual_slot", "shard",
                      F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    records = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("record"),
                          slot_of(key, slots).alias("virtual_slot"))
    # Maps have no hash and no order; as text they have both.
    whole = F.to_json("record") if "map<" in docs.schema.simpleString() else F.col("record")
    in_slot = Window.partitionBy("virtual_slot").orderBy(F.col("record")[key], F.xxhash64(whole))
    return (records.withColumn("nth", F.row_number().over(in_slot))
            .join(F.broadcast(starts), "virtual_slot")
            .select("record", "virtual_slot", "shard",
                    (F.col("start") + F.col("nth") - 1).alias("slot")))


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard, its records in order of their slots within each file."""
    (placed.select("shard", "slot", "record.*")
     .write.partitionBy("shard").parquet(path))
