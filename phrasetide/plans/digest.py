"""Messages to stored posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phrasetide.operators.ingest import keep_one_per_id, read_messages, safe_only, to_posts
from phrasetide.operators.lookup import BROADCAST_BYTES
from phrasetide.operators.percolate import TOP_MATCHES, percolate_top


def digest(messages: DataFrame, registry: DataFrame, n: int = TOP_MATCHES,
           limit: int = BROADCAST_BYTES) -> DataFrame:
    """One row per post and matching query, at most ``n`` per post.

    Duplicates are merged and over-18 posts dropped before the matching. While
    the registry can be broadcast, the shuffle by id of the merge is the only
    one: matching happens in place and ranking finds posts together by id.
    Messages without an id, which can't be stored, go before the merge; left to
    the matching, they would make its two readings of the posts differ, and the
    input be read and shuffled twice.
    """
    posts = safe_only(keep_one_per_id(messages.filter(F.col("id").isNotNull())))
    return to_posts(percolate_top(posts, registry, n, limit=limit))


def digest_lines(lines: DataFrame, registry: DataFrame, on_bad: str = "fail",
                 n: int = TOP_MATCHES) -> DataFrame:
    """The same, starting from raw text lines."""
    return digest(read_messages(lines, on_bad), registry, n)
