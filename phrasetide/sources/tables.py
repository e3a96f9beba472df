"""Keyed tables on plain Parquet.

Every write goes to a folder of its own that is never changed, and one line in
the table's manifest makes it part of the table. A batch is known by its run
(one stream checkpoint, one job, one client) and its number in it: writing it
again replaces that batch alone, wherever other runs stand. A reader takes, for
each key, the row of the newest batch; a batch keeps the place of its first
writing. Compaction adds a folder that covers those it was made from, so
batches written meanwhile stay, and readers of the old folders go on.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phrasetide.operators.lookup import (
    BROADCAST_BYTES, lookup_join, marked_by_bitmap, measured_bytes, row_bytes,
)
from phrasetide.session import path_exists, stored_bytes

# Buckets of topics in a compacted folder.
BUCKETS = 8

# Stored bytes whose rows one task sorts at a time.
TASK_BYTES = 32 * 1024 * 1024

_MANIFEST = ("run string, batch_id bigint, place bigint, copy string, at bigint, "
             "covers array<string>, bucketed boolean")
_FOLDER = [T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType()),
           T.StructField("place", T.LongType()), T.StructField("copy", T.StringType())]


@dataclass(frozen=True)
class Entry:
    """One folder of the table."""

    run: str
    batch_id: int
    place: int
    copy: str
    at: int
    covers: tuple[str, ...] = field(default=())
    bucketed: bool = False

    def folder(self, path: str) -> str:
        return (f"{path}/data/run={self.run}/batch_id={self.batch_id}"
                f"/place={self.place}/copy={self.copy}")


def _entries(spark: SparkSession, path: str, under: str = "") -> list[Entry]:
    """All lines of the manifest: one per write, so as many as batches, not rows."""
    rows = (spark.read.schema(_MANIFEST).option("recursiveFileLookup", "true")
            .json(f"{path}/manifest{under}").collect())
    return [Entry(r.run, r.batch_id, r.place, r.copy, r.at, tuple(r.covers or ()),
                  bool(r.bucketed)) for r in rows]


def _entries_of(spark: SparkSession, path: str, run: str, batch_id: int) -> list[Entry]:
    """The lines of one batch; no other batch's are listed or read."""
    under = _lines_of(run, batch_id)
    return _entries(spark, path, under) if path_exists(spark, f"{path}/manifest{under}") else []


def exists(spark: SparkSession, path: str) -> bool:
    """Whether any batch has been written to the table."""
    return path_exists(spark, f"{path}/manifest")


def _lines_of(run: str, batch_id: int) -> str:
    return f"/run={run}/batch_id={batch_id}"


def live_entries(spark: SparkSession, path: str,
                 skip: tuple[str, int] | None = None) -> list[Entry]:
    """The folders that make up the table now, oldest place first, but for batch ``skip``."""
    newest: dict[tuple[str, int], Entry] = {}
    entries = _entries(spark, path)
    covered = {copy for entry in entries for copy in entry.covers}
    for entry in sorted(entries, key=lambda e: e.at):
        newest[entry.run, entry.batch_id] = entry
    return sorted((e for e in newest.values()
                   if e.copy not in covered and (e.run, e.batch_id) != skip),
                  key=lambda e: (e.place, e.at))


def _add(spark: SparkSession, path: str, entry: Entry) -> None:
    line = (entry.run, entry.batch_id, entry.place, entry.copy, entry.at,
            list(entry.covers), entry.bucketed)
    spark.createDataFrame([line], _MANIFEST).coalesce(1).write.mode("append").json(
        f"{path}/manifest{_lines_of(entry.run, entry.batch_id)}")


def write_batch(rows: DataFrame, path: str, batch_id: int, run: str = "main") -> None:
    """Store ``rows`` as batch ``batch_id`` of ``run``, in place of an earlier writing of it.

    Only this batch's own lines of the manifest are looked at, so the cost of a
    write doesn't grow with the batches written before.
    """
    spark = rows.sparkSession
    own = _entries_of(spark, path, run, batch_id)
    now = max([time.time_ns() // 1000, *(e.at + 1 for e in own)])
    entry = Entry(run, batch_id, min([e.place for e in own], default=now), uuid.uuid4().hex, now)
    rows.write.parquet(entry.folder(path))
    _add(spark, path, entry)


def _read(spark: SparkSession, path: str, schema: T.StructType,
          entries: Sequence[Entry], layout: Sequence[T.StructField] = ()) -> DataFrame:
    full = T.StructType([*schema, *layout, *_FOLDER])
    if not entries:
        return spark.createDataFrame([], full)
    return (spark.read.schema(full).option("basePath", f"{path}/data")
            .parquet(*[e.folder(path) for e in entries]))


def read_batch(spark: SparkSession, path: str, schema: T.StructType, batch_id: int,
               run: str = "main") -> DataFrame:
    """The rows of one batch, as last written."""
    newest = max(_entries_of(spark, path, run, batch_id), key=lambda e: e.at)
    return _read(spark, path, schema, [newest]).select(*schema.fieldNames())


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows, replaced ones included, with their ``run``, ``batch_id`` and ``place``."""
    return _read(spark, path, schema, live_entries(spark, path)).drop("copy")


def read_run(spark: SparkSession, path: str, schema: T.StructType, run: str,
             before: int) -> DataFrame:
    """The rows of the batches of ``run`` before batch ``before``, each as last written."""
    own = f"/run={run}"
    entries = _entries(spark, path, own) if path_exists(spark, f"{path}/manifest{own}") else []
    newest = {e.batch_id: e for e in sorted(entries, key=lambda e: e.at) if e.batch_id < before}
    return _read(spark, path, schema, list(newest.values())).select(*schema.fieldNames())


def task_count(spark: SparkSession, path: str, entries: Sequence[Entry]) -> tuple[int, ...]:
    """Partitions for a shuffle of folders' rows: none, if Spark's own number is enough."""
    needed = -(-stored_bytes(spark, *[e.folder(path) for e in entries]) // TASK_BYTES)
    return (needed,) if needed > int(spark.conf.get("spark.sql.shuffle.partitions")) else ()


def newest_per_key(batches: DataFrame, key: Sequence[str], tasks: Sequence[int] = ()) -> DataFrame:
    """The row of the newest batch (largest ``place``) for each key.

    Filters on key columns of the result reach the Parquet scan, since they are
    the grouping columns here. A key twice in one batch keeps its largest row.
    Rows are shuffled before they are merged, so that they are sorted once.
    """
    return _merged(batches.repartition(*tasks, *key), key)


def _merged(placed: DataFrame, by: Sequence[str]) -> DataFrame:
    """The newest row of each key; ``by`` are the key and what follows from it."""
    rest = [c for c in placed.columns if c not in by and c != "place"]
    best = placed.groupBy(*by).agg(F.max(F.struct("place", *rest)).alias("k"))
    return best.select(*[F.col(c) if c in by else F.col(f"k.{c}")
                         for c in placed.columns if c != "place"])


def _with_recent(old: DataFrame, recent: DataFrame, place: int, key: Sequence[str],
                 limit: int, tasks: Sequence[int]) -> DataFrame:
    """Rows of a compacted folder, of which each is the only one of its key, and later ones.

    Old rows whose keys were written since go; up to ``limit`` these keys are broadcast.
    Beyond it a bitmap of them is, old rows that it rules out stay where they
    are, and the others are merged with the later ones in one shuffle.
    """
    keys = recent.select(*key)
    size = measured_bytes(keys)
    if size > limit:
        size = measured_bytes(keys.distinct())
    if size <= limit:
        kept = old.join(F.broadcast(keys.distinct()), list(key), "left_anti")
        return kept.unionByName(newest_per_key(recent, key, tasks))
    marked = marked_by_bitmap(old, keys, list(key), "_again", limit)
    again = marked.filter("_again").drop("_again").withColumn("place", F.lit(place - 1))
    return (marked.filter("not _again").drop("_again")
            .unionByName(newest_per_key(again.unionByName(recent), key, tasks)))


def bucket_of(topic: str | Column) -> Column:
    return F.pmod(F.xxhash64(topic), F.lit(BUCKETS)).cast("int")


_LAYOUT = [T.StructField("bucket", T.IntegerType()), T.StructField("day", T.DateType())]


def read_table(spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str],
               columns: Sequence[str] | None = None, topics: Sequence[str] | None = None,
               after=None, limit: int = BROADCAST_BYTES,
               days: tuple[date | None, date | None] = (None, None),
               merged: bool = True) -> DataFrame:
    """The table's current rows: the key and ``columns`` (default all).

    ``topics`` (first key column), ``after`` (second key column, a time,
    exclusive) and ``days`` (from one and before another; None is open) narrow
    the read; in a compacted folder they leave whole buckets and days unread. Rows of a compacted folder have one version each: they are
    read without a shuffle, but for the keys written since, which are few and
    broadcast (beyond ``limit`` shuffled). Only rows written since are merged.
    Columns not asked for are neither read nor shuffled. Without ``merged`` all
    versions come, with their ``place``.
    """
    wanted = [f.name for f in schema
              if columns is None or f.name in key or f.name in columns]
    entries = live_entries(spark, path)
    base = entries[0] if entries and entries[0].bucketed else None
    later = entries[1:] if base else entries

    def narrowed(rows: DataFrame, bucketed: bool) -> DataFrame:
        if topics is not None:
            if bucketed:
                numbers = F.transform(F.array(*map(F.lit, topics)), bucket_of)
                found = rows.sparkSession.range(1).select(numbers).first()[0]
                rows = rows.filter(F.col("bucket").isin(found))
            rows = rows.filter(F.col(key[0]).isin(list(topics)))
        if after is not None:
            at = F.lit(after).cast("timestamp")
            if bucketed:
                rows = rows.filter(F.col("day") >= at.cast("date"))
            rows = rows.filter(F.col(key[1]) > at)
        for day, test in zip(days, (Column.__ge__, Column.__lt__)):
            if day is not None:
                at = F.lit(day)
                if bucketed:
                    rows = rows.filter(test(F.col("day"), at))
                rows = rows.filter(test(F.col(key[1]), at.cast("timestamp")))
        return rows

    recent = narrowed(_read(spark, path, schema, later), False).select(*wanted, "place")
    if not merged:
        return recent if base is None else recent.unionByName(narrowed(
            _read(spark, path, schema, [base], _LAYOUT), True).select(*wanted, "place"))
    tasks = task_count(spark, path, entries)
    if base is None:
        return newest_per_key(recent, key, tasks)
    old = narrowed(_read(spark, path, schema, [base], _LAYOUT), True).select(*wanted)
    if not later:
        return old
    return _with_recent(old, recent, base.place, key, limit, tasks)


def stored_days(spark: SparkSession, path: str) -> list[date]:
    """The days that a compacted table has folders of, newest first.

    They are the folders' names; no row is read.
    """
    entries = live_entries(spark, path)
    if not entries or not entries[0].bucketed:
        return []
    files = _read(spark, path, T.StructType(), entries[:1], _LAYOUT).inputFiles()
    found = {m[1] for f in files if (m := re.search(r"/day=(\d+-\d\d-\d\d)/", f))}
    return sorted(map(date.fromisoformat, found), reverse=True)


def read_keys(spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str],
              keys: DataFrame, columns: Sequence[str] | None = None,
              skip: tuple[str, int] | None = None,
              limit: int = BROADCAST_BYTES) -> DataFrame:
    """The current rows of ``keys`` only, a table of the whole key or of its first column.

    Of a compacted folder the buckets (and, with whole keys, the days) that
    ``keys`` turn out to have are read: Spark prunes its partitions when the
    broadcast of the keys is there. Folders written since are scanned from the
    keys' first time on. Keys beyond ``limit`` bytes meet the rows in a shuffle
    instead, whole keys only the rows that a bitmap of them lets pass. ``skip`` names a batch whose rows don't count.
    """
    on = [c for c in key if c in keys.columns]
    wanted = [f.name for f in schema
              if columns is None or f.name in key or f.name in columns]
    timed = len(on) > 1
    # A semi-join asks for no distinct keys; topics are made few for the broadcast.
    keys = keys.select(*on) if timed else keys.select(*on).distinct()
    size, first = keys.agg(F.sum(row_bytes(keys)), F.min(key[1]) if timed else F.lit(None)).first()
    entries = live_entries(spark, path, skip)
    base = entries[0] if entries and entries[0].bucketed else None

    def of_keys(rows: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
        if timed:
            rows = rows.filter(F.col(key[1]) >= F.lit(first))
        some = keys.withColumns({"bucket": bucket_of(on[0]), **(
            {"day": F.to_date(key[1])} if timed else {})})
        # Pruning at run time asks for keys that a filter has made fewer.
        some = some.select(*extra, *on).filter(F.col(on[0]).isNotNull() & (F.col(on[0]) >= ""))
        if timed and (size or 0) > limit:
            # Most rows have none of the keys, and a whole key has few rows: no salt.
            rows = marked_by_bitmap(rows, keys, on, "_known", limit).filter("_known").drop("_known")
            return rows.join(some.hint("shuffle_hash"), [*extra, *on], "left_semi")
        return lookup_join(rows, some, [*extra, *on], "left_semi", list(key), limit, size or 0)

    later = of_keys(_read(spark, path, schema, entries[1:] if base else entries))
    recent = later.select(*wanted, "place")
    tasks = task_count(spark, path, entries)
    if base is None:
        return newest_per_key(recent, key, tasks)
    old = of_keys(_read(spark, path, schema, [base], _LAYOUT),
                  ["bucket", "day"] if timed else ["bucket"]).select(*wanted)
    if len(entries) == 1:
        return old
    return _with_recent(old, recent, base.place, key, limit, tasks)


def compact(spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str]) -> None:
    """Rewrite the current rows as one folder by bucket of topic and day, in place.

    Micro-batches leave many small files. The new folder takes over from those it
    was read from; batches written in the meantime come after it. A topic with a
    third of all rows is spread over its days and, within them, over tasks.
    """
    covered = live_entries(spark, path)
    if not covered:
        return
    topic, at = key[0], key[1]
    rows = read_table(spark, path, schema, key, merged=False).withColumns(
        {"bucket": bucket_of(topic), "day": F.to_date(at)})
    # The copy's name goes in first: an unfinished folder is in no manifest.
    now = max([time.time_ns() // 1000, *(e.at + 1 for e in _entries(spark, path))])
    entry = Entry(f"compact-{uuid.uuid4().hex}", 0, max(e.place for e in covered),
                  uuid.uuid4().hex, now, tuple(e.copy for e in covered), True)
    # Bucket and day follow from the key: rows of a key are in one range, and merged there.
    by = ["bucket", "day", *key]
    ranged = rows.repartitionByRange(*task_count(spark, path, covered), *by)
    (_merged(ranged, by).sortWithinPartitions(*by)
     .write.partitionBy("bucket", "day").parquet(entry.folder(path)))
    _add(spark, path, entry)


def replace_all(rows: DataFrame, path: str, covered: Sequence[Entry]) -> None:
    """Store ``rows`` in place of the folders ``covered``, which they were made from."""
    spark = rows.sparkSession
    now = max([time.time_ns() // 1000, *(e.at + 1 for e in _entries(spark, path))])
    entry = Entry(f"compact-{uuid.uuid4().hex}", 0, max(e.place for e in covered),
                  uuid.uuid4().hex, now, tuple(e.copy for e in covered))
    rows.write.parquet(entry.folder(path))
    _add(spark, path, entry)


# Snapshots that a stream keeps of a small table, in turn.
SNAPSHOTS = 3


def snapshot_path(path: str, batch_id: int) -> str:
    return f"{path}/slot={batch_id % SNAPSHOTS}"


def write_snapshot(rows: DataFrame, path: str, batch_id: int) -> None:
    """The whole of a small table as of ``batch_id``; the third last makes room.

    A batch that is run again starts from its predecessor's snapshot, which is
    still there, and writes the same.
    """
    rows.write.mode("overwrite").parquet(snapshot_path(path, batch_id))


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType,
                  batch_id: int) -> DataFrame:
    return spark.read.schema(schema).parquet(snapshot_path(path, batch_id))


def scan_posts(posts: DataFrame, columns: Sequence[str], registry: DataFrame,
               limit: int = BROADCAST_BYTES) -> DataFrame:
    """``columns`` (``query`` among them) of the posts whose query is registered."""
    return lookup_join(posts.select(*columns), registry.select("query").distinct(), ["query"],
                       "left_semi", list(columns), limit)
