"""The merged feed, kept up to date from a stream of posts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from phrasetide import schemas
from phrasetide.operators.feed import FEED_SIZE, advance_cursor, extend_feed, newest_posts
from phrasetide.operators.lookup import lookup_join, measured_bytes
from phrasetide.sources import tables
from phrasetide.streaming.posts import run_of, start, watermark_of

# Fixed value: how often the feed asks for new posts.
POLL_INTERVAL = "500 milliseconds"


def keep_feed(topics: DataFrame, feed_path: str, k: int = FEED_SIZE) -> Callable[[DataFrame, int], None]:
    """Batch function: merge a batch's posts of ``topics`` into the feed.

    Ranking needs a bounded input, so it runs per batch over the previous feed
    (at most ``k`` rows) and the batch. Snapshots of the last few batches are
    kept; a repeated batch starts from the same predecessor and gives the same
    feed. The topics are measured once, not per batch.
    """
    wanted = topics.select("query").distinct().cache()
    size = measured_bytes(wanted)

    def process(arrived: DataFrame, batch_id: int) -> None:
        spark = arrived.sparkSession
        rows = lookup_join(arrived, wanted, ["query"], "left_semi", ["doc_id"], small_bytes=size)
        if batch_id == 0:
            feed = newest_posts(rows, k)
        else:
            feed = extend_feed(read_feed(spark, feed_path, batch_id - 1), rows, k)
        tables.write_snapshot(feed.select(*schemas.POST_COLUMNS), feed_path, batch_id)

    return process


def read_feed(spark, feed_path: str, batch_id: int) -> DataFrame:
    """The feed as of ``batch_id``."""
    return tables.read_snapshot(spark, feed_path, schemas.POST, batch_id)


def start_feed(posts: DataFrame, topics: DataFrame, feed_path: str, checkpoint: str,
               interval: str | None = POLL_INTERVAL, k: int = FEED_SIZE) -> StreamingQuery:
    return start(posts, keep_feed(topics, feed_path, k), checkpoint, interval, "feed")


def keep_cursor(cursor_path: str) -> Callable[[DataFrame, int], None]:
    """Batch function: advance the cursors by a batch of posts."""
    def process(arrived: DataFrame, batch_id: int) -> None:
        spark = arrived.sparkSession
        old = None
        if batch_id > 0:
            old = tables.read_snapshot(spark, cursor_path, schemas.CURSOR, batch_id - 1)
        tables.write_snapshot(advance_cursor(arrived, old), cursor_path, batch_id)

    return process


def read_cursor(spark, cursor_path: str, batch_id: int) -> DataFrame:
    """The cursors as of ``batch_id``."""
    return tables.read_snapshot(spark, cursor_path, schemas.CURSOR, batch_id)


def start_cursors(posts: DataFrame, checkpoint: str,
                  interval: str | None = POLL_INTERVAL) -> StreamingQuery:
    """Keep the cursors of a stream of posts as its state, one row per topic.

    Nothing but the topics that a batch moves is written, into the state store of
    ``checkpoint``, where :func:`cursors_in_state` reads them.
    """
    moved = posts.groupBy("query").agg(F.max("created_utc").alias("lasttime"))
    return start(moved, lambda rows, batch_id: rows.write.format("noop").mode("overwrite").save(),
                 checkpoint, interval, "cursors", mode="update")


def cursors_in_state(spark, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The cursors that :func:`start_cursors` holds, as of its last batch or of ``batch_id``."""
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(checkpoint)
    newest = state.schema["value"].dataType.names[0]  # the aggregate's only buffer
    return state.select("key.query", F.col("value")[newest].alias("lasttime"))


def shown_once(posts: DataFrame, delay: str, shown: DataFrame | None = None) -> DataFrame:
    """Each post once, under its smallest query, over the whole stream.

    To be run in update mode into a table keyed by ``doc_id``: a post is given
    when it first arrives, and again when a smaller query does. Copies of a post
    carry its time, so its state is freed once the watermark has passed that by
    ``delay``. That state is a row per post, held in memory by default;
    :func:`start_shown_once` calls this per batch and holds none. The rows that
    were ``shown`` before the batch then take part with the three columns that
    decide, and go with it through one shuffle and one sort.
    """
    rest = [c for c in schemas.POST_COLUMNS if c not in ("doc_id", "created_utc", "query")]
    first, posts = ["query"], posts.withWatermark("created_utc", delay)
    if shown is not None:
        # False is before true: a post shown under the same query stays as it is.
        first = ["query", "_new"]
        posts = posts.withColumn("_new", F.lit(True)).unionByName(
            shown.select("doc_id", "created_utc", "query", F.lit(False).alias("_new")),
            allowMissingColumns=True).repartition("doc_id")
    kept = (posts.groupBy("doc_id", F.window("created_utc", "1 second").alias("w"))
            .agg(F.min(F.struct(*first, "created_utc", *rest)).alias("k")))
    if shown is not None:
        kept = kept.filter("k._new")
    return kept.select(*[F.col(c) if c == "doc_id" else F.col(f"k.{c}")
                         for c in schemas.POST_COLUMNS])


def keep_shown(path: str, checkpoint: str, delay: str) -> Callable[[DataFrame, int], None]:
    """Batch function: store a batch's posts that are new, or now under a smaller query.

    What was shown is read from this run's batches in the table. By the watermark
    as of the batch before, late rows are dropped and shown ones no longer read. A
    repeated batch reads its predecessors only, so it stores the same.
    """
    runs: list[str] = []

    def process(arrived: DataFrame, batch_id: int) -> None:
        spark = arrived.sparkSession
        if not runs:
            runs.append(run_of(spark, checkpoint))
        passed = watermark_of(spark, checkpoint, max(0, batch_id - 1)) // 1000
        due = F.col("created_utc") >= F.timestamp_seconds(F.lit(passed))
        shown = tables.read_run(spark, path, schemas.POST, runs[0], batch_id)
        rows = shown_once(arrived.filter(due), delay, shown.filter(due))
        tables.write_batch(rows, path, batch_id, runs[0])

    return process


def start_shown_once(posts: DataFrame, delay: str, path: str, checkpoint: str,
                     interval: str | None = POLL_INTERVAL) -> StreamingQuery:
    """Store the rows of :func:`shown_once` in a table keyed by ``doc_id``.

    The table itself is the state, so no post is held in memory, and a post whose
    query stays is not stored again.
    """
    return start(posts.withWatermark("created_utc", delay), keep_shown(path, checkpoint, delay),
                 checkpoint, interval, "shown")
