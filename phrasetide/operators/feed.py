"""Read paths: newest posts, posts after a cursor, the merged feed, its display."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phrasetide import schemas
from phrasetide.functions.text import absolute_link, has_text, highlight, short_url, split_topics
from phrasetide.functions.times import display_time, instant
from phrasetide.operators.lookup import (
    BROADCAST_BYTES, among, lookup_join, measured_bytes, row_bytes,
)
from phrasetide.operators.percolate import TOP_MATCHES
from phrasetide.operators.votes import span_of
from phrasetide.session import new_work_dir

# Bytes of whole rows that one task sorts when posts are merged.
SORT_BYTES = 32 * 1024 * 1024

FIRST_CALL = 2
FEED_SIZE = 10


def topics_of(lists: DataFrame, column: str, trim: bool = False) -> DataFrame:
    """One row per topic of each comma-separated list, with its position."""
    keep = [c for c in lists.columns if c != column]
    return lists.select(*keep, F.posexplode(split_topics(column, trim)).alias("pos", "topic"))


def newest(posts: DataFrame, topics: DataFrame | None = None, n: int = FIRST_CALL,
           limit: int = BROADCAST_BYTES) -> DataFrame:
    """The ``n`` newest posts of each topic, with their ``rank``.

    Spark applies the rank limit on the map side as well, so a hot topic sends
    ``n`` rows per task into the shuffle.
    """
    if topics is not None:
        posts = lookup_join(posts, topics.select("query").distinct(), ["query"],
                            "left_semi", ["doc_id"], limit)
    by_age = Window.partitionBy("query").orderBy(F.desc("created_utc"), "doc_id")
    return (posts.withColumn("rank", F.row_number().over(by_age))
            .filter(F.col("rank") <= n))


def newest_of(posts: DataFrame, topic: str, n: int = FIRST_CALL) -> DataFrame:
    """One topic's ``n`` newest posts."""
    return (posts.filter(F.col("query") == topic)
            .orderBy(F.desc("created_utc"), "doc_id").limit(n))


def since_of(posts: DataFrame, topic: str, lasttime) -> DataFrame:
    """One topic's posts after ``lasttime``, newest first."""
    return (posts.filter((F.col("query") == topic) & (F.col("created_utc") > F.lit(lasttime)))
            .orderBy(F.desc("created_utc"), "doc_id"))


def in_order(rows: DataFrame) -> DataFrame:
    """Rows with their ``rank`` in the response of their topic, newest first."""
    by_age = Window.partitionBy("query").orderBy(F.desc("created_utc"), "doc_id")
    return rows.withColumn("rank", F.row_number().over(by_age))


def in_order_by_ranges(rows: DataFrame) -> DataFrame:
    """:func:`in_order` for responses of any length: no task ranks a whole topic.

    Rows are written in ranges by topic and age. Each range ranks its own rows,
    which follow those that the ranges before it hold of the same topic.
    """
    spark = rows.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_age = [F.desc("created_utc"), F.col("doc_id")]
    path = new_work_dir(spark, "responses")
    (rows.repartitionByRange(count, "query", *by_age)
     .withColumn("_part", F.spark_partition_id()).write.parquet(path))
    placed = spark.read.parquet(path)
    before = (Window.partitionBy("query").orderBy("_part")
              .rowsBetween(Window.unboundedPreceding, -1))
    # A row per topic and range: about as many as there are of both together.
    starts = (placed.groupBy("query", "_part").agg(F.count("*").alias("n"))
              .select("query", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start")))
    nth = F.row_number().over(Window.partitionBy("query", "_part").orderBy(*by_age))
    ranked = lookup_join(placed.withColumn("_nth", nth), starts, ["query", "_part"], "inner",
                         ["doc_id"])
    return ranked.select(*rows.columns, (F.col("_start") + F.col("_nth")).alias("rank"))


def oldest_first(rows: DataFrame) -> DataFrame:
    """A response in the order its posts join the feed."""
    return rows.orderBy("created_utc", "doc_id")


def since(posts: DataFrame, cursor: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Posts strictly newer than their topic's cursor, for all topics at once.

    The aggregate that measures the cursors also finds the oldest, and the scan
    of the posts starts there.
    """
    known = cursor.filter(F.col("lasttime").isNotNull()).select("query", "lasttime")
    size, oldest, _ = span_of(known)
    if oldest is None:
        return posts.limit(0)
    recent = posts.filter(F.col("created_utc") >= F.timestamp_seconds(F.lit(oldest)))
    return (lookup_join(recent, known, ["query"], "inner", ["doc_id"], limit, size)
            .filter(F.col("created_utc") > F.col("lasttime"))
            .select(*posts.columns))


def poll(posts: DataFrame, cursor: DataFrame, n: int = FIRST_CALL,
         limit: int = BROADCAST_BYTES) -> DataFrame:
    """What one read of every topic returns, in one pass over the posts.

    Topics with a cursor give the posts after it, topics without one
    (``lasttime`` null) their ``n`` newest. Once no topic is new, the scan
    starts at the oldest cursor.
    """
    topics = cursor.select("query", "lasttime")
    size = topics.agg(F.sum(row_bytes(topics)), F.min(F.unix_seconds("lasttime")),
                      F.count_if(F.col("lasttime").isNull())).first()
    if not size[2]:
        return since(posts, cursor, limit)
    rows = (lookup_join(posts, topics, ["query"], "inner", ["doc_id"], limit, size[0] or 0)
            .filter(F.col("lasttime").isNull() | (F.col("created_utc") > F.col("lasttime"))))
    # A known topic's rows are each ranked alone (a stored post's key is unique),
    # so one rank limit holds for all and is applied before the shuffle too.
    alone = F.when(F.col("lasttime").isNotNull(), F.struct("created_utc", "doc_id"))
    by_age = Window.partitionBy("query", alone).orderBy(F.desc("created_utc"), "doc_id")
    return (rows.withColumn("rank", F.row_number().over(by_age))
            .filter(F.col("rank") <= n)
            .select(*posts.columns))


def advance_cursor(rows: DataFrame, cursor: DataFrame | None = None) -> DataFrame:
    """Per topic the newest time read so far; a cursor never moves back.

    Old cursors join in as rows of the same aggregate, which keeps topics that
    returned nothing without a join.
    """
    seen = rows.select("query", F.col("created_utc").alias("lasttime"))
    if cursor is not None:
        seen = seen.unionByName(cursor.select("query", "lasttime"))
    return seen.groupBy("query").agg(F.max("lasttime").alias("lasttime"))


def with_instant(cursor: DataFrame) -> DataFrame:
    """Cursors with the ISO text a client sends back."""
    return cursor.withColumn("instant", instant("lasttime"))


def unseen(posts: DataFrame, seen: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Posts whose ``doc_id`` has not been shown yet."""
    return lookup_join(posts, seen.select("doc_id").distinct(), ["doc_id"], "left_anti",
                       ["query"], limit)


def merge_topics(posts: DataFrame, sort_bytes: int = SORT_BYTES) -> DataFrame:
    """Each post once across topics: its smallest query, at its newest time.

    Whole rows are sorted by id to be merged. The measured size of ``posts`` tells
    into how many pieces they go first, so that a task sorts about ``sort_bytes``
    however large the table is.
    """
    spark = posts.sparkSession
    pieces = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                 -(-measured_bytes(posts) // sort_bytes))
    return _merged(posts.repartition(pieces, "doc_id"))


def _merged(posts: DataFrame) -> DataFrame:
    rest = [c for c in schemas.POST_COLUMNS if c not in ("doc_id", "query", "created_utc")]
    order = F.struct((-F.unix_micros("created_utc")).alias("_age"), "query", "created_utc", *rest)
    return (posts.groupBy("doc_id").agg(F.min(order).alias("k"))
            .select(*[F.col(c) if c == "doc_id" else F.col(f"k.{c}")
                      for c in schemas.POST_COLUMNS]))


def top_feed(posts: DataFrame, topics: DataFrame | None = None, seen: DataFrame | None = None,
             k: int = FEED_SIZE, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The ``k`` newest posts over all topics, each post once, with ``rank``.

    The newest rows are taken first, of two columns and without a shuffle, and
    only they are compared with ``seen``; when too few are left, the look goes
    back further. Only rows as new as the ``k``-th post found are then read
    whole and merged.
    """
    if topics is not None:
        topics = topics.select("query").distinct()
        size = measured_bytes(topics)
        posts = lookup_join(posts, topics, ["query"], "left_semi", ["doc_id"], limit, size)
    shown = posts.filter(has_text("title"))
    if seen is not None:
        seen = seen.select("doc_id")
    reach = F.timestamp_micros(F.lit(_reach(shown, seen, k)).cast("bigint"))
    recent = shown.filter(F.col("created_utc") >= reach)
    if seen is not None:
        # Rows since the reach are few: the seen ids are narrowed to theirs.
        ids = recent.select("doc_id").distinct()
        known = lookup_join(seen, ids, ["doc_id"], "left_semi", ["doc_id"], limit).distinct()
        recent = lookup_join(recent, known, ["doc_id"], "left_anti", ["query"], limit)
    top = _merged(recent).orderBy(F.desc("created_utc"), "doc_id").limit(k)
    return numbered(top)


def _reach(shown: DataFrame, seen: DataFrame | None, k: int) -> int | None:
    """Epoch microseconds at or before the newest time of the ``k``-th newest unseen post.

    Posts match at most ``TOP_MATCHES`` topics each, so that many times ``k``
    rows nearly always hold ``k`` posts. When they do not, a hundred times as
    many are looked at, and then all posts are merged by id to find the time.
    """
    times = shown.select("doc_id", F.unix_micros("created_utc").alias("at"))
    for rows in (k * TOP_MATCHES, 100 * k * TOP_MATCHES):
        head = times.orderBy(F.desc("at")).limit(rows)
        if seen is None:
            marked = head.withColumn("_seen", F.lit(False))
        else:  # the few ids of the head narrow the seen ones, not the other way round
            ids = F.broadcast(head.select("doc_id").distinct())
            known = seen.join(ids, "doc_id", "left_semi").distinct()
            marked = head.join(known.withColumn("_seen", F.lit(True)), "doc_id", "left")
        unseen_id = F.when(~F.coalesce("_seen", F.lit(False)), F.col("doc_id"))
        found = marked.agg(F.count("*").alias("rows"), F.min("at").alias("oldest"),
                           F.count_distinct(unseen_id).alias("posts")).first()
        if found.posts >= k or found.rows < rows:
            return found.oldest
    left = times if seen is None else times.join(seen, "doc_id", "left_anti")
    newest_times = (left.groupBy("doc_id").agg(F.max("at").alias("at"))
                    .orderBy(F.desc("at")).limit(k))
    return newest_times.agg(F.min("at")).first()[0]


def newest_posts(rows: DataFrame, k: int = FEED_SIZE) -> DataFrame:
    """The ``k`` newest posts of a micro-batch, each once, as :func:`top_feed` gives them.

    Two columns tell how far back they reach, and only rows since then are merged,
    however many a batch has. Rows without a time come last.
    """
    shown = rows.filter(has_text("title"))
    reach = F.timestamp_micros(F.lit(_reach(shown, None, k)).cast("bigint"))
    recent = shown.filter((F.col("created_utc") >= reach) | F.col("created_utc").isNull())
    return _merged(recent).orderBy(F.desc("created_utc"), "doc_id").limit(k)


def extend_feed(feed: DataFrame, arrived: DataFrame, k: int = FEED_SIZE) -> DataFrame:
    """The feed after a micro-batch of rows; a post already shown stays as it was."""
    columns = list(schemas.POST_COLUMNS)
    shown = feed.select(*columns)
    fresh = arrived.join(F.broadcast(shown.select("doc_id")), "doc_id", "left_anti")
    newest_first = newest_posts(fresh.select(*columns), k).unionByName(shown)
    return numbered(newest_first.orderBy(F.desc("created_utc"), "doc_id").limit(k))


def numbered(top: DataFrame) -> DataFrame:
    """A feed with its ``rank``, newest first."""
    # At most a feed of rows: an ungrouped window over them is one small task.
    return top.withColumn("rank", F.row_number().over(
        Window.orderBy(F.desc("created_utc"), "doc_id")))


def render(feed: DataFrame) -> DataFrame:
    """Display columns of a feed of at most a screenful of rows.

    ``ui_id`` numbers the rows in the order they would arrive, oldest first.
    """
    arrival = Window.orderBy("created_utc", "doc_id")
    return feed.select(
        (F.row_number().over(arrival) - 1).cast("bigint").alias("ui_id"),
        "doc_id", "query",
        display_time("created_utc").alias("timestamp"),
        short_url("url").alias("link_text"),
        absolute_link("permalink").alias("link"),
        highlight("title", "query").alias("title_html"),
        "ups", "downs",
    )


def enrich(feed: DataFrame, docs: DataFrame, columns: list[str],
           limit: int = BROADCAST_BYTES) -> DataFrame:
    """Feed rows with ``columns`` replaced by the looked-up post's, where found.

    A post that is found replaces the values whatever it holds, nulls included.
    ``docs`` is narrowed to the feed's ids first, so the large table is scanned
    but not shuffled while the feed is small; of several rows of one id the
    smallest counts.
    """
    wanted = feed.select("doc_id").distinct()
    found = lookup_join(docs.select("doc_id", *columns), wanted, ["doc_id"],
                        "left_semi", ["doc_id"], limit)
    details = (found.groupBy("doc_id").agg(F.min(F.struct(*columns)).alias("_new")))
    joined = feed.join(details, "doc_id", "left")
    replaced = {c: F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}"))
                .otherwise(F.col(c) if c in feed.columns else F.lit(None)) for c in columns}
    kept = [c for c in feed.columns if c not in columns]
    return joined.select(*kept, *[value.alias(c) for c, value in replaced.items()])


# Rows of a feed whose ids are looked up one by one.
SCREEN = 1000


def enrich_screen(feed: DataFrame, docs: DataFrame, columns: list[str],
                  limit: int = BROADCAST_BYTES) -> DataFrame:
    """:func:`enrich` for at most a screenful of rows, reading few row groups of ``docs``.

    The ids come to the driver and go into the scan as values to look for. From a
    table with Bloom filters of its ids (:func:`details.write_details`) only those
    row groups are read that may hold one of them. A longer feed is joined.
    """
    ids = [r["doc_id"] for r in feed.select("doc_id").filter(F.col("doc_id").isNotNull())
           .distinct().limit(SCREEN + 1).collect()]
    if len(ids) <= SCREEN:
        docs = docs.filter(among("doc_id", ids))
    return enrich(feed, docs, columns, limit)


def new_ids(current: DataFrame, fetched: DataFrame, key: str = "doc_id") -> DataFrame:
    """Ids in ``current`` that were not fetched before, each once."""
    return current.select(key).subtract(fetched.select(key))
