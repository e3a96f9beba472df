"""Hourly totals and sliding counts over a stream of posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from phrasetide.operators.votes import (
    FIRST_HOUR, counted_posts, of_registered, paned_counts, sliding_counts, sum_votes, to_votes,
)
from phrasetide.streaming.posts import BATCH_INTERVAL, LiveRegistry, start, store


def closed_hours(posts: DataFrame, delay: str, bounds: str = "half_open",
                 registry: DataFrame | None = None,
                 first_hour: str | None = FIRST_HOUR) -> DataFrame:
    """Totals of hours that have ended ``delay`` before the newest post.

    Posts count by the rules of the batch job (:func:`votes.hourly_votes`). Each
    hour is emitted once (append mode); posts arriving later than that are not
    counted. State holds the open hours only.
    """
    wanted = counted_posts(posts, bounds, first_hour)
    return of_registered(to_votes(sum_votes(wanted.withWatermark("created_utc", delay))), registry)


def closed_slides(posts: DataFrame, delay: str, length: str = "5 minutes",
                  every: str = "1 minute") -> DataFrame:
    """Post counts per topic and sliding window, once the window has closed."""
    return sliding_counts(posts.withWatermark("created_utc", delay), length, every)


def closed_panes(posts: DataFrame, delay: str, length: str = "5 minutes",
                 every: str = "1 minute") -> DataFrame:
    """The rows of :func:`closed_slides` from two aggregates in a row.

    The first holds one row per topic and open pane, the second one per topic
    and open window, and gets closed panes only.
    """
    return paned_counts(posts.withWatermark("created_utc", delay), length, every)


def start_votes(posts: DataFrame, votes_path: str, checkpoint: str, delay: str,
                interval: str | None = BATCH_INTERVAL, bounds: str = "half_open",
                registry_path: str | None = None,
                first_hour: str | None = FIRST_HOUR) -> StreamingQuery:
    """Keep the votes table filled with closed hours.

    All topics are totalled in the stream; ``registry_path`` limits what is stored
    to the topics registered when their hour closes. The registry is looked at
    for every batch, so a topic registered while the job runs has totals from the
    next closed hour on, whole ones.
    """
    keep = store(votes_path, checkpoint)
    known = LiveRegistry(registry_path) if registry_path else None

    def process(totals: DataFrame, batch_id: int) -> None:
        keep(of_registered(totals, known.read(totals.sparkSession) if known else None), batch_id)

    return start(closed_hours(posts, delay, bounds, None, first_hour), process, checkpoint,
                 interval, "votes")
