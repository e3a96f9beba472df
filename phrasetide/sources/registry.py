"""Registered queries; a query is its own key."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phrasetide import schemas
from phrasetide.sources import tables


def registrations(topics: DataFrame, at, column: str = "topic") -> DataFrame:
    """Registry rows of ``topics``, registered at ``at``."""
    return (topics.select(F.col(column).alias("query")).distinct()
            .withColumn("registered_at", F.lit(at).cast("timestamp")))


def register(rows: DataFrame, path: str) -> None:
    """Add registrations; each call is a batch of its own, whoever makes it.

    Repeating a call or a query changes nothing, as the first time counts.
    """
    tables.write_batch(rows, path, 0, run=f"client-{uuid.uuid4().hex}")


def first_registrations(rows: DataFrame) -> DataFrame:
    """Each query once, as of its first registration."""
    return rows.groupBy("query").agg(F.min("registered_at").alias("registered_at"))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return first_registrations(
        tables.read_batches(spark, path, schemas.REGISTRY).select("query", "registered_at"))


def compact(spark: SparkSession, path: str) -> None:
    """Rewrite the registry as one folder, each query once, in place.

    A registry gains a small folder per registration and is read by every
    micro-batch. Registrations made meanwhile stay, and a running stream goes on
    with the same path.
    """
    covered = tables.live_entries(spark, path)
    if covered:
        tables.replace_all(read_registry(spark, path), path, covered)


def registered_by(registry: DataFrame, at) -> DataFrame:
    """Queries known at ``at``: one registered later matches later posts only."""
    return registry.filter(F.col("registered_at") <= F.lit(at).cast("timestamp"))
