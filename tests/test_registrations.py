"""Posts and registrations as two streams, sliding counts from panes, live registries."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phrasetide import schemas
from phrasetide.operators import ingest, votes
from phrasetide.sources import registry, tables
from phrasetide.sources.topic import FolderTopic
from phrasetide.streaming import feed, metrics, registrations
from phrasetide.streaming.posts import read_delays, read_posts, start, start_posts, store
from phrasetide.streaming.votes import closed_panes, closed_slides, start_votes

POSTS = "id string, title string, at timestamp"
MATCHES = "query string, doc_id string, created_utc timestamp, registered_at timestamp"


def at(text: str) -> datetime:
    return datetime.fromisoformat("2024-01-" + text)


@pytest.fixture
def run(spark, tmp_path):
    """Turns of (posts, registrations) through one pair of streams; the matches so far."""
    posts, known, stored, checkpoint = (str(tmp_path / n) for n in ("p", "r", "m", "c"))

    def turn(new_posts, new_queries, valid="5 days"):
        spark.createDataFrame([(i, t, at(d)) for i, t, d in new_posts], POSTS).write.mode(
            "append").parquet(posts)
        spark.createDataFrame([(q, at(d)) for q, d in new_queries], schemas.REGISTRY).write.mode(
            "append").parquet(known)
        rows = registrations.matches(
            spark.readStream.schema(POSTS).parquet(posts),
            spark.readStream.schema(schemas.REGISTRY).parquet(known),
            "at", "1 hour", "1 hour", valid)
        start(rows, store(stored, checkpoint), checkpoint, interval=None).awaitTermination()
        got = tables.read_batches(spark, stored, T.StructType.fromDDL(MATCHES)).select("query", "doc_id").collect()
        return sorted((r.query, r.doc_id) for r in got)
    return turn


def test_a_query_matches_from_its_registration_until_its_end(run):
    first = run([("a", "Old York", "01 10:00"), ("b", "old york bridge", "02 10:00"),
                 ("none", None, "02 10:00"), ("c", "York", "09 00:00")],
                [("york", "02 10:00"), ("!!!", "01 00:00")])
    assert first == [("york", "b")]  # a is earlier, c after five days
    # The registration of a phrase arrives after the posts it falls under, not late.
    second = run([], [("old york bridge", "02 09:30"), ("OLD york", "02 10:01")])
    assert second == [("old york bridge", "b"), ("york", "b")]


def test_what_is_late_is_dropped(run):
    run([("a", "york", "05 10:00")], [("york", "05 09:00")])
    # The watermark is an hour before the older of the two newest times: 8:00.
    got = run([("b", "york", "05 07:00"), ("d", "bridge", "05 11:00"), ("e", "york bridge", "05 12:00")],
              [("bridge", "05 07:59"), ("Bridge", "05 11:30")])
    assert got == [("Bridge", "e"), ("york", "a"), ("york", "e")]


def test_long_phrases_and_repeated_registrations(run):
    long = "one two three four five"
    got = run([("a", "zero one two three four five six", "01 10:00"),
               ("b", "one two three four six five", "01 10:00")],
              [(long, "01 09:00"), ("two", "01 09:00"), ("two", "01 09:30"), ("one three", "01 09:00")])
    assert got == [(long, "a"), ("two", "a"), ("two", "a"), ("two", "b"), ("two", "b")]


@pytest.fixture
def held(spark, tmp_path):
    """The same turns with posts held as they are; the matches and how many rows are held."""
    posts, known, rows, stored, checkpoint = (str(tmp_path / n) for n in ("p", "r", "h", "m", "c"))

    def turn(new_posts, new_queries, valid="5 days"):
        spark.createDataFrame([(i, t, at(d)) for i, t, d in new_posts], POSTS).write.mode(
            "append").parquet(posts)
        spark.createDataFrame([(q, at(d)) for q, d in new_queries], schemas.REGISTRY).write.mode(
            "append").parquet(known)
        registrations.start_matches(
            spark.readStream.schema(POSTS).parquet(posts),
            spark.readStream.schema(schemas.REGISTRY).parquet(known),
            "at", "1 hour", "1 hour", valid, rows, stored, checkpoint,
            interval=None).awaitTermination()
        got = tables.read_batches(spark, stored, T.StructType.fromDDL(MATCHES)).collect()
        return (sorted((r.query, r.doc_id) for r in got),
                spark.read.parquet(f"{rows}/rows").count())
    return turn


def test_a_held_post_is_one_row_and_matches_like_the_join(held):
    first = held([("a", "Old York", "01 10:00"), ("b", "old york bridge", "02 10:00"),
                  ("none", None, "02 10:00"), ("c", "York", "09 00:00")],
                 [("york", "02 10:00"), ("!!!", "01 00:00")])
    assert first == ([("york", "b")], 5)
    second, _ = held([], [("old york bridge", "02 09:30"), ("OLD york", "02 10:01")])
    assert second == [("old york bridge", "b"), ("york", "b")]


def test_late_rows_are_dropped_and_passed_ones_freed(held):
    held([("a", "york", "05 10:00")], [("york", "05 09:00")])
    got, rows = held([("b", "york", "05 07:00"), ("d", "bridge", "05 11:00"),
                      ("e", "york bridge", "05 12:00")],
                     [("bridge", "05 07:59"), ("Bridge", "05 11:30")])
    assert got == [("Bridge", "e"), ("york", "a"), ("york", "e")] and rows == 5
    held([("f", "none", "30 00:00")], [("none", "30 00:00")])
    got, rows = held([("g", "none", "30 01:00"), ("h", "york", "05 12:00")], [])
    assert got[:2] == [("Bridge", "e"), ("none", "f")] and len(got) == 5 and rows == 3
    assert held([], [("none", "30 00:30")]) == (sorted([*got, ("none", "g")]), 4)


def test_held_long_phrases_and_repeated_registrations(held):
    long = "one two three four five"
    got, _ = held([("a", "zero one two three four five six", "01 10:00"),
                   ("b", "one two three four six five", "01 10:00")],
                  [(long, "01 09:00"), ("two", "01 09:00"), ("two", "01 09:30"), ("one three", "01 09:00")])
    assert got == [(long, "a"), ("two", "a"), ("two", "a"), ("two", "b"), ("two", "b")]


def slides(rows):
    return sorted((r.query, r.until_utc, r.n) for r in rows.collect())


def test_panes_give_the_sliding_counts(spark, posts, tmp_path):
    rows = posts(*[(q, f"2024-01-01 10:{m:02}:{s:02}", f"{q}{m}{s}") for q in "ab"
                   for m in (0, 1, 4, 5, 20, 59) for s in (0, 30, 59)])
    assert slides(votes.paned_counts(rows)) == slides(votes.sliding_counts(rows))
    rows.repartition(3).write.parquet(str(tmp_path / "p"))
    schema = T.StructType.fromDDL("query string, until_utc timestamp, n bigint")
    found = []
    for name, closed in (("slides", closed_slides), ("panes", closed_panes)):
        path, checkpoint = str(tmp_path / name), str(tmp_path / (name + "-ck"))
        stream = spark.readStream.schema(schemas.POST).parquet(str(tmp_path / "p"))
        query = start(closed(stream, "10 minutes"), store(path, checkpoint), checkpoint, interval=None)
        query.awaitTermination()
        found.append(slides(tables.read_batches(spark, path, schema)))
    assert found[0] == found[1] and len(found[0]) > 20
    # The first of the two aggregates holds a row per topic and open pane.
    panes = spark.read.format("statestore").option("operatorId", 1).load(str(tmp_path / "panes-ck"))
    assert panes.count() <= 2 * 11


def test_a_topic_registered_while_the_job_runs_has_the_next_closed_hours(spark, posts, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("p", "r", "v", "c")}
    topics = lambda q: spark.createDataFrame([(q,)], "topic string")
    for hour, topic in (((10, 11), "a"), ((12, 15), "b")):
        registry.register(registry.registrations(topics(topic), "2024-01-01"), paths["r"])
        posts(*[(q, f"2024-01-01 {h}:30:00", f"{q}{h}", h, 0) for q in "abc"
                for h in hour]).write.mode("append").parquet(paths["p"])
        stream = spark.readStream.schema(schemas.POST).parquet(paths["p"])
        start_votes(stream, paths["v"], paths["c"], "30 minutes", interval=None,
                    registry_path=paths["r"]).awaitTermination()
    got = tables.read_table(spark, paths["v"], schemas.VOTES, schemas.VOTE_KEY)
    assert sorted((r.query, r.ups) for r in got.collect()) == [
        ("a", 10), ("a", 11), ("a", 12), ("b", 11), ("b", 12)]


def test_series_at_the_grain_of_their_span(spark, posts):
    hourly = votes.hourly_votes(posts(
        ("q", "2024-01-01 10:10:00", "a", 1, 2), ("q", "2024-01-01 11:10:00", "b", 3, 0),
        ("q", "2024-01-31 00:00:00", "c", 5, 5), ("q", "2024-02-01 00:00:00", "d", 7, 0),
        ("r", "2023-12-31 23:59:59", "e", 1, 1)))
    totals = votes.grain_totals(hourly)
    got = {(r.query, r.grain, str(r.time_utc)[:13]): (r.ups, r.downs) for r in totals.collect()}
    assert got[("q", "month", "2024-01-01 00")] == (9, 7) and got[("q", "day", "2024-01-01 00")] == (4, 2)
    assert got[("q", "hour", "2024-01-01 11")] == (3, 0) and len(got) == 4 + 3 + 2 + 3
    for span, points in (("1 day", 2), ("20 days", 2), ("40 days", 3), ("2 years", 2)):
        assert votes.drawn_series(totals, span).filter(F.col("query") == "q").count() == points


def test_sketches_of_batches_merge_within_their_error(spark):
    rows = spark.range(30_000).select((F.col("id") % 7).alias("batch"),
                                      (F.pow("id", F.lit(2)) / 1000).cast("bigint").alias("ms"))
    sketches = metrics.quantile_sketch(rows, F.col("ms"), ("batch",))
    values = sorted(r.ms for r in rows.collect())
    for share, value, n in metrics.sketched_quantiles(sketches, (0.01, 0.5, 0.95)).collect():
        below = sum(v < value for v in values) / len(values)
        upto = sum(v <= value for v in values) / len(values)
        assert n == 30_000
        assert below <= share + metrics.SKETCH_ERROR and upto >= share - metrics.SKETCH_ERROR
    none = metrics.quantile_sketch(rows.limit(0), F.col("ms"), ("batch",))
    assert metrics.sketched_quantiles(none, (0.5,)).count() == 0


def test_a_stream_leaves_the_delays_of_its_batches(spark, lines, line, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("values", "r", "p", "c", "d")}
    topic = FolderTopic(paths["values"])
    registry.register(registry.registrations(
        spark.createDataFrame([("york",)], "topic string"), "2024-01-01"), paths["r"])
    for i in range(2):
        topic.publish(ingest.to_values(ingest.read_messages(
            lines(*[line(id=f"{i}-{n}") for n in range(5)]))))
        start_posts(topic.stream(spark, published=True), paths["r"], paths["p"], paths["c"],
                    interval=None, delays_path=paths["d"]).awaitTermination()
    assert read_posts(spark, paths["p"]).count() == 10
    (low, high) = sorted(read_delays(spark, paths["d"], (0.0, 1.0)).collect())
    assert low.n == high.n == 10 and 0 <= low.value <= high.value < 120_000


def test_cursors_are_read_from_the_state_of_a_restarted_stream(spark, posts, tmp_path):
    path, checkpoint = str(tmp_path / "p"), str(tmp_path / "c")
    for rows in ([("q", "2024-01-02", "a"), ("r", "2024-01-01", "b")],
                 [("q", "2024-01-01", "c"), ("s", "2024-01-05", "d")]):
        posts(*rows).write.mode("append").parquet(path)
        stream = spark.readStream.schema(schemas.POST).parquet(path)
        feed.start_cursors(stream, checkpoint, interval=None).awaitTermination()
    got = {r.query: str(r.lasttime)[:10] for r in feed.cursors_in_state(spark, checkpoint).collect()}
    assert got == {"q": "2024-01-02", "r": "2024-01-01", "s": "2024-01-05"}
    first = feed.cursors_in_state(spark, checkpoint, batch_id=0)
    assert sorted(r.query for r in first.collect()) == ["q", "r"]
