from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from phrasetide import schemas
from phrasetide.operators import ingest
from phrasetide.plans.digest import digest
from phrasetide.sources import registry as reg
from phrasetide.sources import tables
from phrasetide.sources.topic import FolderTopic
from phrasetide.streaming import feed as feed_stream
from phrasetide.streaming import metrics
from phrasetide.streaming import posts as post_stream
from phrasetide.streaming import votes as vote_stream


@pytest.fixture
def paths(tmp_path):
    return lambda name: str(tmp_path / name)


def messages(lines, line, *items):
    return ingest.read_messages(lines(*[
        line(id=i, title=t, created_utc=1704103200 + n) for n, (i, t) in enumerate(items)]))


def register(spark, path, *queries):
    topics = spark.createDataFrame([(q,) for q in queries], "topic string")
    reg.register(reg.registrations(topics, "2024-01-01"), path)


def drain(spark, topic, paths):
    query = post_stream.start_posts(topic.stream(spark), paths("registry"), paths("posts"),
                                    paths("checkpoint"), interval=None)
    query.awaitTermination()
    return query


def stored(spark, paths):
    return post_stream.read_posts(spark, paths("posts"))


def test_stream_equals_batch_and_replay_is_harmless(spark, lines, line, paths):
    register(spark, paths("registry"), "a", "b", "a b")
    topic = FolderTopic(paths("topic"), files_per_batch=1)
    made = messages(lines, line, *[(f"m{i}", t) for i, t in enumerate(
        ["a b", "b a", "c", "a a", "B!", "x a b y"])])
    topic.publish(ingest.to_values(made).repartition(3))
    log = metrics.ProgressLog(spark)
    query = drain(spark, topic, paths)
    reports = log.table(query).collect()
    log.close()
    known = reg.read_registry(spark, paths("registry"))
    want = sorted(digest(made, known).collect())
    assert sorted(stored(spark, paths).collect()) == want
    assert sum(r.messages for r in reports) == 6 and all(r.duration_ms > 0 for r in reports)
    # The last batch is run again after a crash: in its own place, same rows.
    post_stream.store_matches(paths("registry"), paths("posts"), paths("checkpoint"))(made, 2)
    assert len(tables.live_entries(spark, paths("posts"))) == 3
    assert sorted(stored(spark, paths).collect()) == want


def test_registry_is_read_in_every_batch(spark, lines, line, paths):
    topic = FolderTopic(paths("topic"))
    register(spark, paths("registry"), "a")
    topic.publish(ingest.to_values(messages(lines, line, ("m1", "a b"))))
    drain(spark, topic, paths)
    register(spark, paths("registry"), "b")
    topic.publish(ingest.to_values(messages(lines, line, ("m2", "a b"))))
    drain(spark, topic, paths)
    got = sorted((r.doc_id, r.query) for r in stored(spark, paths).collect())
    assert got == [("m1", "a"), ("m2", "a"), ("m2", "b")]


def test_empty_messages_and_batch_duplicates(spark, lines, line, paths):
    topic = FolderTopic(paths("topic"))
    register(spark, paths("registry"), "a")
    twice = ingest.to_values(messages(lines, line, ("m1", "a"), ("m1", "a")))
    topic.publish(twice.unionByName(spark.createDataFrame([("{}",)], "value string")).coalesce(1))
    drain(spark, topic, paths)
    assert [r.doc_id for r in stored(spark, paths).collect()] == ["m1"]


def post_files(posts, path, *batches):
    for rows in batches:
        posts(*rows).coalesce(1).write.mode("append").parquet(path)


def post_stream_of(spark, path):
    return (spark.readStream.schema(schemas.POST).option("maxFilesPerTrigger", 1).parquet(path))


def collect_stream(spark, df, paths, schema):
    query = post_stream.start(df, post_stream.store(paths("out"), paths("ck")),
                              paths("ck"), interval=None)
    query.awaitTermination()
    return (tables.read_batches(spark, paths("out"), schema)
            .select(*schema.fieldNames()).collect())


def test_closed_hours_drop_late_posts(spark, posts, paths):
    post_files(posts, paths("in"),
               [("q", "2024-01-01 00:10:00", "a", 1, 0), ("q", "2024-01-01 01:00:00", "b", 2, 0)],
               [("q", "2024-01-01 05:00:00", "c", 4, 0)],
               [("q", "2024-01-01 05:10:00", "d", 8, 0)],
               [("q", "2024-01-01 00:20:00", "late", 16, 0)],
               [("q", "2024-01-02 05:00:00", "end", 32, 0)])
    rows = vote_stream.closed_hours(post_stream_of(spark, paths("in")), "1 hour")
    got = collect_stream(spark, rows, paths, schemas.VOTES)
    assert sorted((r.time_utc.hour, r.ups) for r in got) == [(0, 1), (1, 2), (5, 12)]


def test_closed_hours_follow_first_hour_and_registry(spark, posts, registry, paths):
    post_files(posts, paths("in"),
               [("q", "2006-12-31 23:10:00", "old", 1, 0), ("q", "2024-01-01 01:00:00", "b", 2, 0),
                ("x", "2024-01-01 01:00:00", "b", 2, 0)],
               [("q", "2024-01-03 00:00:01", "end", 1, 0)])
    rows = vote_stream.closed_hours(post_stream_of(spark, paths("in")), "1 hour",
                                    registry=registry("q"))
    got = collect_stream(spark, rows, paths, schemas.VOTES)
    assert [(r.query, r.time_utc.year, r.ups) for r in got] == [("q", 2024, 2)]


def test_closed_hours_with_open_bounds(spark, posts, paths):
    post_files(posts, paths("in"),
               [("q", "2024-01-01 01:00:00", "b", 2, 0), ("q", "2024-01-01 01:00:01", "c", 4, 0)],
               [("q", "2024-01-03 00:00:01", "end", 1, 0)])
    rows = vote_stream.closed_hours(post_stream_of(spark, paths("in")), "1 hour", "open")
    assert [r.ups for r in collect_stream(spark, rows, paths, schemas.VOTES)] == [4]


def test_feed_over_batches(spark, posts, registry, paths, tmp_path):
    post_files(posts, paths("in"),
               [("b", "2024-01-01 00:00:01", "x"), ("z", "2024-01-09 00:00:00", "other topic")],
               [("a", "2024-01-01 00:00:01", "x"), ("a", "2024-01-01 00:00:03", "y")],
               [("a", "2024-01-01 00:00:02", "w")])
    query = feed_stream.start_feed(post_stream_of(spark, paths("in")), registry("a", "b"),
                                   paths("feed"), paths("ck"), interval=None, k=2)
    query.awaitTermination()
    got = [{(r.query, r.doc_id) for r in feed_stream.read_feed(spark, paths("feed"), i).collect()}
           for i in range(3)]
    assert got == [{("b", "x")}, {("b", "x"), ("a", "y")}, {("a", "y"), ("a", "w")}]
    post_files(posts, paths("in"), [("a", "2024-01-01 00:00:09", "v")])
    query = feed_stream.start_feed(post_stream_of(spark, paths("in")), registry("a", "b"),
                                   paths("feed"), paths("ck"), interval=None, k=2)
    query.awaitTermination()
    assert len([f for f in (tmp_path / "feed").iterdir() if f.is_dir()]) == tables.SNAPSHOTS


def test_cursor_over_batches(spark, posts, paths):
    post_files(posts, paths("in"), [("q", "2024-01-05", "a"), ("r", "2024-01-01", "b")],
               [("q", "2024-01-03", "c")])
    query = post_stream.start(post_stream_of(spark, paths("in")),
                              feed_stream.keep_cursor(paths("cur")), paths("ck"), interval=None)
    query.awaitTermination()
    got = feed_stream.read_cursor(spark, paths("cur"), 1).collect()
    assert {r.query: r.lasttime.day for r in got} == {"q": 5, "r": 1}


def test_shown_once_over_batches_under_the_smallest_query(spark, posts, paths):
    post_files(posts, paths("in"), [("b", "2024-01-01", "x")],
               [("a", "2024-01-01", "x"), ("b", "2024-01-01", "y")], [("c", "2024-01-01", "x")])
    once = feed_stream.shown_once(post_stream_of(spark, paths("in")), "1 day")
    query = post_stream.start(once, post_stream.store(paths("out"), paths("ck")), paths("ck"),
                              interval=None, mode="update")
    query.awaitTermination()
    got = tables.read_table(spark, paths("out"), schemas.POST, ["doc_id"]).collect()
    assert sorted((r.doc_id, r.query) for r in got) == [("x", "a"), ("y", "b")]


def shown_rows(spark, path):
    rows = tables.read_batches(spark, path, schemas.POST).collect()
    return sorted((r.batch_id, r.doc_id, r.query, str(r.created_utc)) for r in rows)


def test_posts_shown_once_are_not_stored_again_or_held_as_state(spark, posts, paths):
    post_files(posts, paths("in"), [("b", "2024-01-01", "x"), ("d", "2024-01-01", "x")],
               [("a", "2024-01-01", "x"), ("b", "2024-01-01", "y")],
               [("c", "2024-01-01", "x"), ("b", "2024-01-01", "y")])
    query = feed_stream.start_shown_once(post_stream_of(spark, paths("in")), "1 day",
                                         paths("out"), paths("ck"), interval=None)
    query.awaitTermination()
    assert [r[:3] for r in shown_rows(spark, paths("out"))] == [
        (0, "x", "b"), (1, "x", "a"), (1, "y", "b")]
    assert all(not p["stateOperators"] for p in query.recentProgress)
    got = tables.read_table(spark, paths("out"), schemas.POST, ["doc_id"]).collect()
    assert sorted((r.doc_id, r.query, r.title) for r in got) == [
        ("x", "a", "a title"), ("y", "b", "a title")]


def test_posts_shown_once_by_batches_are_those_of_the_stream(spark, posts, paths):
    """Late rows, nulls, times within a second and an id at two times among them."""
    post_files(posts, paths("in"),
               [("b", "2024-01-05", "x"), (None, "2024-01-05", "n"), ("b", None, "z")],
               [("c", "2024-01-01", "late1"), ("a", "2024-01-09 00:00:00.7", "y"),
                ("z", "2024-01-09 00:00:00.2", "y"), ("a", "2024-01-06", "x")],
               [("a", "2024-01-03 23:59:59.9", "late2"), ("a", "2024-01-04", "on time"),
                ("a", "2024-01-05", "x"), ("a", "2024-01-05", "n")],
               [("a", "2024-01-07 23:59:59", "late3"), ("b", "2024-01-08", "w")])
    once = feed_stream.shown_once(post_stream_of(spark, paths("in")), "1 day")
    post_stream.start(once, post_stream.store(paths("old"), paths("ck1")), paths("ck1"),
                      interval=None, mode="update").awaitTermination()
    feed_stream.start_shown_once(post_stream_of(spark, paths("in")), "1 day", paths("new"),
                                 paths("ck2"), interval=None).awaitTermination()
    old, new = shown_rows(spark, paths("old")), shown_rows(spark, paths("new"))
    # The stream gives a post of a batch again though its query stays.
    assert set(new) <= set(old)
    assert {r[1:] for r in new} == {r[1:] for r in old}
    assert "on time" in {r[1] for r in new} and not {"late2", "late3"} & {r[1] for r in new}


def test_posts_shown_once_after_a_restart_and_a_repeated_batch(spark, posts, paths):
    def turn(*files):
        post_files(posts, paths("in"), *files)
        query = feed_stream.start_shown_once(post_stream_of(spark, paths("in")), "1 day",
                                             paths("out"), paths("ck"), interval=None)
        query.awaitTermination()

    turn([("b", "2024-01-01", "x"), ("c", "2024-01-01", "y")])
    turn([("c", "2024-01-01", "x"), ("a", "2024-01-01", "y")])
    wanted = [(0, "x", "b"), (0, "y", "c"), (1, "y", "a")]
    assert [r[:3] for r in shown_rows(spark, paths("out"))] == wanted
    process = feed_stream.keep_shown(paths("out"), paths("ck"), "1 day")
    for batch_id, rows in ((1, [("c", "2024-01-01", "x"), ("a", "2024-01-01", "y")]),
                           (0, [("b", "2024-01-01", "x"), ("c", "2024-01-01", "y")])):
        process(posts(*rows), batch_id)
        assert [r[:3] for r in shown_rows(spark, paths("out"))] == wanted


def test_new_checkpoint_keeps_what_is_stored(spark, lines, line, paths):
    register(spark, paths("registry"), "a")
    for name in ("one", "two"):
        topic = FolderTopic(paths(name))
        topic.publish(ingest.to_values(messages(lines, line, (name, "a"))))
        post_stream.start_posts(topic.stream(spark), paths("registry"), paths("posts"),
                                paths(f"ck-{name}"), interval=None).awaitTermination()
    assert sorted(r.doc_id for r in stored(spark, paths).collect()) == ["one", "two"]


def test_a_cleared_checkpoint_is_another_run(spark, lines, line, paths):
    register(spark, paths("registry"), "a")
    topic = FolderTopic(paths("topic"))
    topic.publish(ingest.to_values(messages(lines, line, ("m", "a"))))
    post_stream.cancel(drain(spark, topic, paths), paths("checkpoint"), paths("topic"))
    topic.publish(ingest.to_values(messages(lines, line, ("n", "a"))))
    drain(spark, topic, paths)
    assert sorted(r.doc_id for r in stored(spark, paths).collect()) == ["m", "n"]


def test_cancel_clears_and_stop_keeps(spark, lines, line, paths):
    register(spark, paths("registry"), "a")
    topic = FolderTopic(paths("topic"))
    topic.publish(ingest.to_values(messages(lines, line, ("m", "a"))))
    post_stream.stop(drain(spark, topic, paths))
    assert stored(spark, paths).count() == 1
    post_stream.cancel(drain(spark, topic, paths), paths("posts"), paths("checkpoint"),
                       paths("not there"))
    drain(spark, topic, paths)
    assert [e.batch_id for e in tables.live_entries(spark, paths("posts"))] == [0]
    assert [r.doc_id for r in stored(spark, paths).collect()] == ["m"]


def test_repeats_across_batches_can_be_dropped(spark, posts, paths):
    post_files(posts, paths("in"), [("a", "2024-01-01", "x")], [("a", "2024-01-01 00:00:05", "x")])
    stream = post_stream_of(spark, paths("in")).select(F.col("doc_id").alias("id"), "created_utc")
    kept = post_stream.drop_repeats(stream, "created_utc", "1 hour")
    got = collect_stream(spark, kept, paths, kept.schema)
    assert [r.created_utc for r in got] == [datetime(2024, 1, 1)]


def test_stop_keeps_results_and_restart_resumes(spark, posts, paths):
    post_files(posts, paths("in"), [("a", "2024-01-01", "x")])
    stream = post_stream_of(spark, paths("in"))
    keep = feed_stream.keep_cursor(paths("cur"))
    query = post_stream.start(stream, keep, paths("ck"), interval="100 milliseconds")
    query.processAllAvailable()
    post_stream.stop(query)
    assert not query.isActive
    post_files(posts, paths("in"), [("a", "2024-01-02", "y")])
    again = post_stream.start(stream, keep, paths("ck"), interval=None)
    again.awaitTermination()
    assert again.lastProgress["batchId"] == 1
    assert feed_stream.read_cursor(spark, paths("cur"), 1).first().lasttime.day == 2


def test_observed_count(spark, lines, line):
    counted, seen = metrics.counted(messages(lines, line, ("a", "x"), ("b", "y")))
    counted.write.format("noop").mode("overwrite").save()
    assert seen.get == {"messages": 2}
