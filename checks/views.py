"""Posts, registries and cursors derived from the driver tables.

Every view reads its tables whole. Times are TIMESTAMP (session zone UTC).
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phrasetide import schemas
from phrasetide.functions.times import to_epoch_text
from phrasetide.operators.feed import advance_cursor
from phrasetide.operators.ingest import read_messages
from phrasetide.operators.votes import hourly_votes
from phrasetide.plans.digest import digest
from phrasetide.session import new_work_dir, stored_bytes
from phrasetide.sources.files import read_lines, spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ntz(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps without zone, the form both engines compare."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def event_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One post per event; its title is made of three part names."""
    events = spread(table(spark, sf_dir, "events"))
    part = table(spark, sf_dir, "part")
    parts = part.agg(F.count("*")).scalar()
    for i, factor in enumerate((1, 7, 13), start=1):
        name = part.select(F.col("p_partkey").alias(f"k{i}"), F.col("p_name").alias(f"p{i}"))
        key = F.col("event_id") * factor % parts
        events = events.withColumn(f"k{i}", key).join(name, f"k{i}")
    ups = F.floor("value").cast("bigint")
    given = (F.col("event_id") * 7919 + 13) % (1 + ups)
    return events.select(
        F.col("event_id").cast("string").alias("id"),
        F.concat_ws(" ", F.when(F.col("event_type") == "view", F.upper("p1"))
                    .otherwise(F.col("p1")), "p2", "p3").alias("title"),
        F.concat(F.lit("/r/"), "event_type", F.lit("/comments/"), "event_id").alias("permalink"),
        F.concat(F.lit("http://ex.org/"), "event_type", F.lit("/"),
                 F.col("event_id") * 7919).alias("url"),
        F.concat(F.lit("User"), "user_id").alias("author"),
        F.col("event_type").alias("subreddit"),
        F.col("ts").cast("timestamp").alias("created_utc"),
        (F.col("value") >= 150).alias("over_18"),
        ups.alias("ups"),
        given.alias("downs"),
        F.when(F.col("event_type") != "click", F.length("props")).cast("bigint").alias("gilded"),
        (ups - given).alias("score"),
    )


def document_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One post per document, titled with its whole text; toxic ones are over-18."""
    docs = table(spark, sf_dir, "documents")
    events = table(spark, sf_dir, "events")
    pages = table(spark, sf_dir, "pages")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    n_pages = pages.agg(F.count("*")).scalar()
    ups = F.floor("value").cast("bigint")
    return (docs.join(events, F.col("event_id") == F.col("doc_id"))
            .withColumn("page_id", F.col("doc_id") % n_pages)
            .join(pages.select("page_id", F.col("url").alias("link")), "page_id")
            .join(labels, "doc_id", "left")
            .select(
                F.col("doc_id").cast("string").alias("id"),
                F.col("text").alias("title"),
                F.concat(F.lit("/r/"), "source", F.lit("/comments/"), "doc_id").alias("permalink"),
                F.col("link").alias("url"),
                F.concat(F.lit("User"), "user_id").alias("author"),
                F.col("source").alias("subreddit"),
                F.col("ts").cast("timestamp").alias("created_utc"),
                (F.col("toxic") == 1).alias("over_18"),
                ups.alias("ups"),
                F.lit(0).cast("bigint").alias("downs"),
                F.length("props").cast("bigint").alias("gilded"),
                ups.alias("score"),
            ))


def raw_lines(posts: DataFrame) -> DataFrame:
    """Posts as JSON lines with epoch seconds.

    Nulls are written out. Posts without up-votes lack the key ``gilded``.
    """
    seconds = to_epoch_text("created_utc").cast("decimal(20,6)").alias("created_utc")
    columns = [seconds if c == "created_utc" else F.col(c) for c in schemas.REQUIRED_KEYS]
    short = [c for c, name in zip(columns, schemas.REQUIRED_KEYS) if name != "gilded"]
    keep_nulls = {"ignoreNullFields": "false"}
    return posts.select(
        F.when(F.col("ups") == 0, F.to_json(F.struct(*short), keep_nulls))
        .otherwise(F.to_json(F.struct(*columns), keep_nulls)).alias("line"))


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event posts as lines of text files, written once per session."""
    return read_lines(spark, _lines_path(spark, sf_dir))


@cache
def _lines_path(spark: SparkSession, sf_dir: str) -> str:
    path = new_work_dir(spark, "lines")
    raw_lines(event_posts(spark, sf_dir)).write.text(path)
    return path


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_messages(event_lines(spark, sf_dir))


def document_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document posts as messages; unlabelled documents count as safe."""
    posts = document_posts(spark, sf_dir)
    return posts.withColumns({
        "over_18": F.coalesce("over_18", F.lit(False)),
        "created_utc": to_epoch_text("created_utc"),
    }).select(*schemas.MESSAGE.fieldNames())


def part_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part name and each of its words as a registered query."""
    part = table(spark, sf_dir, "part").select("p_name").distinct()
    return (part.select(F.col("p_name").alias("query"))
            .unionByName(part.select(F.explode(F.split("p_name", " ")).alias("query")))
            .distinct())


def benchmark_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark text, whole, and each of its words as written."""
    texts = table(spark, sf_dir, "benchmark").select("text")
    words = F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    return (texts.select(F.col("text").alias("query"))
            .unionByName(texts.select(F.explode(words).alias("query")))
            .distinct())


def word_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-word queries of the part registry, as the topics of a feed."""
    return part_registry(spark, sf_dir).filter(~F.contains("query", F.lit(" ")))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored posts of all events, written once per session and read back."""
    return spark.read.schema(schemas.POST).parquet(_posts_path(spark, sf_dir))


@cache
def _posts_path(spark: SparkSession, sf_dir: str) -> str:
    path = new_work_dir(spark, "posts")
    made = digest(event_messages(spark, sf_dir), part_registry(spark, sf_dir))
    made.write.parquet(path)
    return path


def posts_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Bytes of the files that :func:`posts` reads."""
    return stored_bytes(spark, _posts_path(spark, sf_dir))


def minute_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored posts with whole-minute times, so that some fall on the hour."""
    return posts(spark, sf_dir).withColumn("created_utc", F.date_trunc("MINUTE", "created_utc"))


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_votes(minute_posts(spark, sf_dir))


def cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word topics were last read at their newest sign-up post, the others never."""
    rows = posts(spark, sf_dir)
    read = advance_cursor(rows.filter(F.col("subreddit") == "signup"))
    known = read.withColumn(
        "lasttime", F.when(~F.contains("query", F.lit(" ")), F.col("lasttime")))
    topics = part_registry(spark, sf_dir)
    return topics.join(known, "query", "left")
