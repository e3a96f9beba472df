"""Column layouts shared by batch and streaming code."""

from __future__ import annotations

from pyspark.sql import types as T

# The keys every post line must carry.
REQUIRED_KEYS = (
    "id", "title", "permalink", "url", "author", "subreddit", "created_utc",
    "over_18", "ups", "downs", "gilded", "score",
)

# Columns of a stored match, one row per post and topic.
POST_COLUMNS = (
    "query", "created_utc", "doc_id", "subreddit", "title", "permalink", "url",
    "author", "ups", "downs",
)

# Columns that identify a stored row; a later write of the same key replaces it.
POST_KEY = ("query", "created_utc", "doc_id")
VOTE_KEY = ("query", "time_utc")

# created_utc stays text: posts carry it as a number or as a numeric string.
MESSAGE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("permalink", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("subreddit", T.StringType()),
    T.StructField("created_utc", T.StringType()),
    T.StructField("over_18", T.BooleanType()),
    T.StructField("ups", T.LongType()),
    T.StructField("downs", T.LongType()),
    T.StructField("gilded", T.LongType()),
    T.StructField("score", T.LongType()),
])

# Numbers that must be whole; up-votes must be there as well.
WHOLE = ("ups", "gilded", "score")

# over_18 is read as a variant so that false and 0 can be told from "false", and
# numbers as text so that 3.0 can be told from 3.5.
RAW_MESSAGE = T.StructType([
    T.StructField(f.name, T.VariantType() if f.name == "over_18" else T.StringType())
    for f in MESSAGE
])

POST = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("created_utc", T.TimestampType()),
    T.StructField("doc_id", T.StringType()),
    T.StructField("subreddit", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("permalink", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("ups", T.LongType()),
    T.StructField("downs", T.LongType()),
])

VOTES = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("time_utc", T.TimestampType()),
    T.StructField("ups", T.LongType()),
    T.StructField("downs", T.LongType()),
])

# Totals that changes move: with the number of posts, to know when an hour is empty.
VOTE_TOTALS = T.StructType([*VOTES, T.StructField("posts", T.LongType())])

REGISTRY = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("registered_at", T.TimestampType()),
])

CURSOR = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("lasttime", T.TimestampType()),
])
