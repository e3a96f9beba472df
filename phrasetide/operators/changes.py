"""Vote totals moved by changes of posts, retractions among them.

A post that is written again takes its old votes back and gives its new ones:
its old row counts with minus, its new row with plus. Totals then move by the
sums of the changes, and no other post is looked at again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phrasetide import schemas
from phrasetide.operators.votes import FIRST_HOUR, counted_posts

# What an hour's total is made of; an hour without posts has none.
AMOUNTS = ("ups", "downs", "posts")


def one_per_key(rows: DataFrame, key: Sequence[str] = schemas.POST_KEY) -> DataFrame:
    """A batch's rows, of a key that is there twice the largest, as a stored table keeps it.

    Rows are shuffled before they are merged, so that they are sorted once.
    """
    rest = [c for c in rows.columns if c not in key]
    best = rows.repartition(*key).groupBy(*key).agg(F.max(F.struct(*rest)).alias("k"))
    return best.select(*[F.col(c) if c in key else F.col(f"k.{c}") for c in rows.columns])


def changes_of(new: DataFrame, old: DataFrame) -> DataFrame:
    """Posts with their ``sign``: ``old`` rows go (-1) and ``new`` ones come (1)."""
    columns = ["query", "created_utc", "ups", "downs"]
    return (new.select(*columns, F.lit(1).alias("sign"))
            .unionByName(old.select(*columns, F.lit(-1).alias("sign"))))


def vote_changes(changes: DataFrame, bounds: str = "half_open",
                 first_hour: str | None = FIRST_HOUR) -> DataFrame:
    """By how much each query's hour moves: ``ups``, ``downs`` and number of ``posts``.

    Posts count as in :func:`votes.hourly_votes`. Changes are summed before the
    shuffle; hours that stay as they are have no row.
    """
    signed = counted_posts(changes, bounds, first_hour)
    moved = (signed.groupBy("query", F.date_trunc("HOUR", "created_utc").alias("time_utc"))
             .agg(F.sum(F.col("sign") * F.col("ups")).alias("ups"),
                  F.sum(F.col("sign") * F.col("downs")).alias("downs"),
                  F.sum("sign").alias("posts")))
    return moved.filter(" or ".join(f"{c} != 0" for c in AMOUNTS))


def moved_totals(totals: DataFrame, moves: DataFrame) -> DataFrame:
    """``totals`` after ``moves``; both have the vote key and the amounts.

    An hour whose last post went stays as a row of no posts, so that it can be
    stored over its predecessor.
    """
    columns = [*schemas.VOTE_KEY, *AMOUNTS]
    both = totals.select(*columns).unionByName(moves.select(*columns))
    return both.groupBy(*schemas.VOTE_KEY).agg(*[F.sum(c).alias(c) for c in AMOUNTS])


def shown_totals(totals: DataFrame) -> DataFrame:
    """The totals of hours that have posts."""
    return totals.filter(F.col("posts") > 0).select(*schemas.VOTES.fieldNames())
