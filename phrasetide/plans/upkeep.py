"""A posts table and its hourly totals, kept up together batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from phrasetide import schemas
from phrasetide.operators.changes import (
    changes_of, moved_totals, one_per_key, shown_totals, vote_changes,
)
from phrasetide.operators.votes import FIRST_HOUR
from phrasetide.session import new_work_dir
from phrasetide.sources import tables


def upsert_posts(rows: DataFrame, posts_path: str, totals_path: str, batch_id: int,
                 run: str = "main", bounds: str = "half_open",
                 first_hour: str | None = FIRST_HOUR) -> None:
    """Store ``rows`` as a batch of the posts table and move the totals by what it changes.

    Of the posts only the batch's own keys are read, of the totals only the
    hours that move. Batches come one after another; the last one may be stored
    again (after a failure between the two tables, say): what it wrote before
    doesn't count then, neither as old posts nor as old totals.
    """
    spark, skip = rows.sparkSession, (run, batch_id)
    tables.write_batch(one_per_key(rows.select(*schemas.POST_COLUMNS)), posts_path, batch_id, run)
    # Merged once: from here on the stored rows are read.
    rows = tables.read_batch(spark, posts_path, schemas.POST, batch_id, run)
    old = _known(spark, posts_path, schemas.POST, schemas.POST_KEY, rows, ["ups", "downs"], skip)
    path = new_work_dir(spark, "vote-changes")
    vote_changes(changes_of(rows, old), bounds, first_hour).write.parquet(path)
    moves = spark.read.parquet(path)
    before = _known(spark, totals_path, schemas.VOTE_TOTALS, schemas.VOTE_KEY, moves, None, skip)
    tables.write_batch(moved_totals(before, moves), totals_path, batch_id, run)


def _known(spark, path, schema, key, keys, columns, skip) -> DataFrame:
    """What a table holds of ``keys``; nothing as long as it has no other batch."""
    if not tables.exists(spark, path) or not tables.live_entries(spark, path, skip):
        return spark.createDataFrame([], schema)
    return tables.read_keys(spark, path, schema, key, keys, columns, skip)


def read_totals(spark: SparkSession, totals_path: str) -> DataFrame:
    """The hourly totals as of the last batch: as ``votes.hourly_votes`` of all posts."""
    return shown_totals(tables.read_table(spark, totals_path, schemas.VOTE_TOTALS,
                                          schemas.VOTE_KEY))
