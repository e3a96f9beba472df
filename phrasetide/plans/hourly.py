"""Stored posts to the stored hourly votes."""

from __future__ import annotations

from pyspark.sql import SparkSession

from phrasetide import schemas
from phrasetide.operators.votes import FIRST_HOUR, hourly_votes
from phrasetide.sources import registry, tables


def total_votes(spark: SparkSession, posts_path: str, registry_path: str, votes_path: str,
                batch_id: int, bounds: str = "half_open", first_hour: str | None = FIRST_HOUR) -> None:
    """Total every hour of the posts table in one pass and store the result.

    The job's batches are numbered by the caller and are a run of their own, so
    they never take the place of those of a stream into the same table.
    """
    posts = tables.read_table(spark, posts_path, schemas.POST, schemas.POST_KEY,
                              columns=["ups", "downs"])
    known = registry.read_registry(spark, registry_path)
    tables.write_batch(hourly_votes(posts, known, bounds, first_hour), votes_path, batch_id, run="hourly")
