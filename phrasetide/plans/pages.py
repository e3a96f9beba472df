"""The merged feed read from a stored table by descending days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phrasetide import schemas
from phrasetide.operators.feed import FEED_SIZE, numbered, top_feed
from phrasetide.sources import tables


def newest_feed(spark: SparkSession, posts_path: str, topics: DataFrame | None = None,
                seen: DataFrame | None = None, k: int = FEED_SIZE) -> DataFrame:
    """:func:`feed.top_feed` of a compacted posts table, reading its newest days only.

    The newest day is read first (with what was written since, however new). As
    long as there are fewer than ``k`` posts, an older post could still be among
    them, so older days are read, each time as many again as before; what is
    older than ``k`` posts found can't be. Found posts are ``k`` rows at most and
    go to the next step as ids not to be shown again. A table that isn't
    compacted is read as a whole.
    """
    days = tables.stored_days(spark, posts_path)
    found: list = []
    before, size = None, 1
    while True:
        # The last step has no lower end: rows written since may be older.
        oldest = days[size - 1] if size < len(days) else None
        rows = tables.read_table(spark, posts_path, schemas.POST, schemas.POST_KEY,
                                 days=(oldest, before))
        shown = spark.createDataFrame([(r["doc_id"],) for r in found], "doc_id string")
        hidden = shown if seen is None else seen.select("doc_id").unionByName(shown)
        found += top_feed(rows, topics, hidden if found or seen is not None else None, k).select(
            *schemas.POST_COLUMNS).collect()
        if len(found) >= k or oldest is None:
            break
        before, size = oldest, 2 * size
    top = spark.createDataFrame(found, schemas.POST)
    return numbered(top.orderBy(F.desc("created_utc"), "doc_id").limit(k))
