"""Live matching: message values in, stored posts out."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from phrasetide import schemas
from phrasetide.plans.digest import digest
from phrasetide.operators.ingest import from_values
from phrasetide.sources import registry, tables
from phrasetide.streaming import metrics

BATCH_INTERVAL = "2 seconds"


def start(stream, batch_fn: Callable[[DataFrame, int], None], checkpoint: str,
          interval: str | None = BATCH_INTERVAL, name: str | None = None,
          mode: str = "append") -> StreamingQuery:
    """Run ``batch_fn`` on every micro-batch; ``interval=None`` drains and ends.

    Offsets are kept in ``checkpoint``, so a restart goes on where it stopped.
    """
    writer = (stream.writeStream.foreachBatch(batch_fn).outputMode(mode)
              .option("checkpointLocation", checkpoint))
    if name:
        writer = writer.queryName(name)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the run that ``checkpoint`` belongs to, the same after a restart."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def watermark_of(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark that batch ``batch_id`` began with, in milliseconds; 0 at first."""
    lines = spark.read.text(f"{checkpoint}/offsets/{batch_id}").collect()
    return next(json.loads(r.value)["batchWatermarkMs"] for r in lines
                if "batchWatermarkMs" in r.value)


def store(path: str, checkpoint: str) -> Callable[[DataFrame, int], None]:
    """Batch function: store each batch in a table, as one of this checkpoint's run.

    To be made anew for each start: a checkpoint that was deleted meanwhile is
    another run, though its path is the same.
    """
    runs: list[str] = []

    def process(rows: DataFrame, batch_id: int) -> None:
        if not runs:
            runs.append(run_of(rows.sparkSession, checkpoint))
        tables.write_batch(rows, path, batch_id, runs[0])

    return process


class LiveRegistry:
    """A registry that may grow between batches, read again only when it has."""

    def __init__(self, path: str):
        self.path = path
        self.held: tuple[tuple[str, ...], DataFrame] | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        version = tuple(e.copy for e in tables.live_entries(spark, self.path))
        if self.held is None or self.held[0] != version:
            if self.held is not None:
                self.held[1].unpersist()
            self.held = version, registry.read_registry(spark, self.path).persist()
        return self.held[1]


def store_matches(registry_path: str, posts_path: str,
                  checkpoint: str) -> Callable[[DataFrame, int], None]:
    """Batch function: match one batch of messages and store the posts.

    The registry's manifest is read in every batch, so a query registered now
    takes part from the next batch on; the registry itself is read again only
    when it has changed. Duplicates are merged within the batch; across batches
    the stored key takes care of them.
    """
    keep, known = store(posts_path, checkpoint), LiveRegistry(registry_path)

    def process(messages: DataFrame, batch_id: int) -> None:
        keep(digest(messages, known.read(messages.sparkSession)), batch_id)

    return process


def start_posts(values: DataFrame, registry_path: str, posts_path: str, checkpoint: str,
                interval: str | None = BATCH_INTERVAL, on_bad: str = "fail",
                delays_path: str | None = None) -> StreamingQuery:
    """Store the matches of a stream of message values.

    With ``delays_path``, values come with their ``published_at``, and every
    batch leaves a sketch there of how long after it its values were stored.
    """
    process = store_matches(registry_path, posts_path, checkpoint)
    if delays_path is None:
        return start(from_values(values, on_bad), process, checkpoint, interval, "posts")
    keep = store(delays_path, checkpoint)

    def timed(batch: DataFrame, batch_id: int) -> None:
        process(from_values(batch, on_bad), batch_id)
        stored = F.lit(datetime.now(timezone.utc))
        keep(metrics.quantile_sketch(batch, metrics.millis_between(
            F.col("published_at"), stored)), batch_id)

    return start(values, timed, checkpoint, interval, "posts")


def read_delays(spark: SparkSession, delays_path: str, shares: Sequence[float]) -> DataFrame:
    """Milliseconds from publishing to storing (``value``) at ``shares`` of all values."""
    return metrics.sketched_quantiles(
        tables.read_batches(spark, delays_path, metrics.SKETCHES), shares)


def drop_repeats(messages: DataFrame, at: str, delay: str) -> DataFrame:
    """Optional: drop ids seen before within ``delay``, across batches too.

    ``at`` names a timestamp column; state older than the watermark is freed.
    """
    return messages.withWatermark(at, delay).dropDuplicatesWithinWatermark(["id"])


def read_posts(spark, posts_path: str) -> DataFrame:
    return tables.read_table(spark, posts_path, schemas.POST, schemas.POST_KEY)


def stop(query: StreamingQuery) -> None:
    """End a query. Its checkpoint and tables stay: starting it again resumes."""
    query.stop()


def cancel(query: StreamingQuery, *paths: str) -> None:
    """End a query and delete ``paths``: its checkpoint and the tables it filled.

    Starting it again begins afresh. Paths that aren't there are passed over.
    """
    query.stop()
    delete(*paths)


def delete(*paths: str) -> None:
    """Delete folders; those that aren't there are passed over."""
    for path in paths:
        system, folder = fs.FileSystem.from_uri(path)
        if system.get_file_info(folder).type == fs.FileType.Directory:
            system.delete_dir(folder)
