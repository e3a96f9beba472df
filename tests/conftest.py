from __future__ import annotations

import json

import pytest

from phrasetide import schemas
from phrasetide.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": 4, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def line():
    """Build one JSON post line; ``drop`` names keys to leave out."""
    def make(drop: tuple[str, ...] = (), **changes) -> str:
        post = {"id": "a1", "title": "Old York Bridge", "permalink": "/r/P/comments/a1",
                "url": "http://Ex.org/a1", "author": "Ann", "subreddit": "Pics",
                "created_utc": 1704103200, "over_18": False, "ups": 7, "downs": 0,
                "gilded": 0, "score": 7, "extra": [1, 2]}
        post.update(changes)
        return json.dumps({k: v for k, v in post.items() if k not in drop})
    return make


@pytest.fixture
def lines(spark):
    return lambda *texts: spark.createDataFrame([(t,) for t in texts], "line string")


@pytest.fixture
def registry(spark):
    return lambda *queries: spark.createDataFrame([(q,) for q in queries], "query string")


@pytest.fixture
def posts(spark):
    """Stored posts from (query, created_utc text, doc_id[, ups, downs, title]) tuples."""
    def make(*rows):
        full = []
        for row in rows:
            query, at, doc_id, ups, downs, title = (*row, 1, 0, "a title")[:6] if len(row) == 3 \
                else (*row, "a title")[:6]
            full.append((query, at, doc_id, "s", title, "/p/" + doc_id, "http://u/" + doc_id,
                         "ann", ups, downs))
        frame = spark.createDataFrame(
            full, "query string, created_utc string, doc_id string, subreddit string, title string,"
                  "permalink string, url string, author string, ups bigint, downs bigint")
        return frame.withColumn("created_utc", frame.created_utc.cast("timestamp")) \
                    .select(*schemas.POST_COLUMNS)
    return make
