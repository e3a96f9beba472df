"""Matching of two streams: posts, and registrations of phrase queries.

A query matches the posts from its registration on, for as long as it is valid.
Both sides carry event times and watermarks, so a post may come before the
registration that it falls under, and neither side is held for ever.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from phrasetide.functions.text import contains_phrase, grams, phrase, tokens
from phrasetide.operators.lookup import lookup_join
from phrasetide.operators.percolate import MAX_GRAM
from phrasetide.sources import tables
from phrasetide.streaming.posts import BATCH_INTERVAL, delete, start, store

# Either kind of row while it is held, and what is known of a batch's held rows.
_ROW = "is_post boolean, name string, at timestamp, text string"
_HELD = "is_post boolean, batch_id bigint, newest bigint"


def offered_grams(posts: DataFrame, at: str, delay: str, key: str = "id",
                  text: str = "title") -> DataFrame:
    """A stream of posts as one row per distinct run of up to ``MAX_GRAM`` tokens.

    Only the key, the time and the normalised text are held as state.
    """
    rows = (posts.select(F.col(key).alias("doc_id"), F.col(at).alias("created_utc"),
                         tokens(text).alias("_tokens"))
            .withWatermark("created_utc", delay))
    runs = F.concat(*[grams("_tokens", n) for n in range(1, MAX_GRAM + 1)])
    return (rows.select("doc_id", "created_utc", F.array_join("_tokens", " ").alias("_text"),
                        F.array_distinct(runs).alias("_grams"))
            .select("doc_id", "created_utc", "_text", F.explode_outer("_grams").alias("gram")))


def filed_phrases(registrations: DataFrame, delay: str) -> DataFrame:
    """A stream of registrations (``query``, ``registered_at``), each under one run.

    A phrase of more than ``MAX_GRAM`` tokens is filed under the one of its runs
    that a hash chooses, so that phrases of one opening don't all meet there.
    """
    rows = (registrations.select("query", "registered_at", phrase("query").alias("phrase"))
            .filter(F.length("phrase") > 0).withWatermark("registered_at", delay))
    rows = rows.withColumn("_words", F.split("phrase", " "))
    runs = F.transform(F.filter(grams("_words", MAX_GRAM), F.isnotnull),
                       lambda g: F.struct(F.xxhash64(g).alias("h"), g.alias("gram")))
    long = F.size("_words") > MAX_GRAM
    return rows.select("query", "registered_at", "phrase", long.alias("_long"),
                       F.when(long, F.array_min(runs)["gram"]).otherwise(F.col("phrase"))
                       .alias("gram"))


def matches(posts: DataFrame, registrations: DataFrame, at: str, post_delay: str,
            registration_delay: str, valid: str, key: str = "id",
            text: str = "title") -> DataFrame:
    """``query``, ``doc_id``, ``created_utc`` and ``registered_at`` of every match.

    A query matches posts with ``registered_at <= created_utc <= registered_at +
    valid``; registering it again prolongs it, and then a post may match by both.
    What is late is dropped: a post or registration older than the watermark,
    which is the older of the two streams' newest times less their delays, as of
    the batch before. A post is held until the registrations' watermark has
    passed it, a registration until the posts' watermark has passed its end.
    """
    left = offered_grams(posts, at, post_delay, key, text)
    right = filed_phrases(registrations, registration_delay)
    end = F.col("registered_at") + F.expr(f"interval {valid}")
    met = left.join(right, (left["gram"] == right["gram"])
                    & (F.col("registered_at") <= F.col("created_utc"))
                    & (F.col("created_utc") <= end))
    return (met.filter(~F.col("_long") | contains_phrase("_text", "phrase"))
            .select("query", "doc_id", "created_utc", "registered_at"))


def _met(posts: DataFrame, registrations: DataFrame, valid: str) -> DataFrame:
    """Matches of two batches of held rows."""
    left = offered_grams(posts, "at", "0 seconds", "name", "text")
    right = filed_phrases(registrations.select(
        F.col("name").alias("query"), F.col("at").alias("registered_at")), "0 seconds")
    end = F.col("registered_at") + F.expr(f"interval {valid}")
    return (lookup_join(left, right, ["gram"], "inner", ["doc_id"])
            .filter((F.col("registered_at") <= F.col("created_utc"))
                    & (F.col("created_utc") <= end)
                    & (~F.col("_long") | contains_phrase("_text", "phrase")))
            .select("query", "doc_id", "created_utc", "registered_at"))


def _micros(at: str, interval: str, sign: str) -> Column:
    return F.unix_micros(F.expr(f"timestamp_micros({at}) {sign} interval {interval}"))


def hold_and_match(post_delay: str, registration_delay: str, valid: str, held_path: str,
                   keep: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Batch function: match a batch's posts and registrations with each other and those held.

    A batch's rows are held in a folder of its own, a row per post, and are offered
    as runs of tokens only while they are matched. ``keep`` stores the matches. A
    folder is deleted once the watermark as of the batch before has passed all its
    rows; a repeated batch starts from its predecessor's notes and does the same.
    """
    def folder(batch_id: int) -> str:
        return f"{held_path}/rows/batch_id={batch_id}"

    def read(spark: SparkSession, batches: list[int], is_post: bool) -> DataFrame:
        if not batches:
            return spark.createDataFrame([], _ROW)
        rows = spark.read.schema(_ROW).option("basePath", f"{held_path}/rows").parquet(
            *map(folder, batches))
        return rows.filter(F.col("is_post") == is_post).select("is_post", "name", "at", "text")

    def process(batch: DataFrame, batch_id: int) -> None:
        spark, notes = batch.sparkSession, f"{held_path}/notes"
        before = []
        if batch_id > 0:
            delay = F.when(F.col("is_post"), _micros("newest", post_delay, "-")).otherwise(
                _micros("newest", registration_delay, "-"))
            end = F.when(F.col("is_post"), F.col("newest")).otherwise(
                _micros("newest", valid, "+"))
            before = tables.read_snapshot(spark, notes, _HELD, batch_id - 1).select(
                "*", delay.alias("mark"), end.alias("end")).collect()
        marks = [max([r.mark for r in before if r.is_post is side], default=None)
                 for side in (True, False)]
        watermark = None if None in marks else min(marks)
        held = [r for r in before if watermark is None or r.end >= watermark]
        fresh = batch.filter(F.col("at").isNotNull() if watermark is None
                             else F.unix_micros("at") > watermark)
        fresh.write.mode("overwrite").partitionBy("is_post").parquet(folder(batch_id))
        posts, registrations = (read(spark, [batch_id], side) for side in (True, False))
        old_posts, old_registrations = (
            read(spark, [r.batch_id for r in held if r.is_post is side], side)
            for side in (True, False))
        keep(_met(posts, old_registrations.unionByName(registrations), valid)
             .unionByName(_met(old_posts, registrations, valid)), batch_id)
        newest = (posts.unionByName(registrations).groupBy("is_post")
                  .agg(F.max(F.unix_micros("at")).alias("newest")).collect())
        # The newest of either kind stays noted, as the watermark is taken from it.
        noted = {(r.is_post, r.batch_id): r.newest for r in before
                 if r in held or r.newest == max(o.newest for o in before if o.is_post is r.is_post)}
        noted |= {(r.is_post, batch_id): r.newest for r in newest}
        tables.write_snapshot(spark.createDataFrame(
            [(*k, n) for k, n in noted.items()], _HELD).coalesce(1), notes, batch_id)
        kept = {r.batch_id for r in held}
        delete(*{folder(r.batch_id) for r in before if r.batch_id not in kept})

    return process


def start_matches(posts: DataFrame, registrations: DataFrame, at: str, post_delay: str,
                  registration_delay: str, valid: str, held_path: str, matches_path: str,
                  checkpoint: str, interval: str | None = BATCH_INTERVAL, key: str = "id",
                  text: str = "title") -> StreamingQuery:
    """Store the rows of :func:`matches`, holding one row per post instead of one per run.

    The two streams are one query, each of whose batches is matched by batch joins:
    new posts with all registrations held, new registrations with the posts held.
    What is late is the same.
    """
    rows = (posts.select(F.lit(True).alias("is_post"), F.col(key).alias("name"),
                         F.col(at).alias("at"), F.col(text).alias("text"))
            .unionByName(registrations.filter(F.length(phrase("query")) > 0).select(
                F.lit(False).alias("is_post"), F.col("query").alias("name"),
                F.col("registered_at").alias("at"), F.lit(None).cast("string").alias("text"))))
    process = hold_and_match(post_delay, registration_delay, valid, held_path,
                             store(matches_path, checkpoint))
    return start(rows, process, checkpoint, interval, "matches")
