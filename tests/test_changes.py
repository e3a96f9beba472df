"""Totals kept up by changes, reads by keys, and the newest days of a stored table."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from phrasetide import schemas
from phrasetide.operators import changes, feed, lookup, votes
from phrasetide.plans import pages, upkeep
from phrasetide.sources import tables
from tests.test_plans import plan


def totals(rows):
    return sorted(tuple(r) for r in rows.select(*schemas.VOTES.fieldNames()).collect())


def read_posts(spark, path):
    return tables.read_table(spark, path, schemas.POST, schemas.POST_KEY)


def test_a_rewritten_post_takes_its_old_votes_back(spark, posts):
    old = posts(("q", "2024-01-01 10:10:00", "a", 5, 1), ("q", "2024-01-01 11:10:00", "b", 2, 2))
    new = posts(("q", "2024-01-01 10:10:00", "a", 7, 1), ("q", "2024-01-01 10:20:00", "c", 1, 0),
                ("q", "2024-01-01 11:10:00", "b", 2, 2))
    moves = changes.vote_changes(changes.changes_of(new, old)).collect()
    assert [(r.time_utc.hour, r.ups, r.downs, r.posts) for r in moves] == [(10, 3, 0, 1)]


def test_an_hour_whose_last_post_goes_is_not_shown(spark, posts):
    first = posts(("q", "2024-01-01 10:10:00", "a", 5, 1), ("r", "2024-01-01 10:10:00", "a", 0, 0))
    none = first.limit(0)
    before = changes.moved_totals(spark.createDataFrame([], schemas.VOTE_TOTALS),
                                  changes.vote_changes(changes.changes_of(first, none)))
    assert totals(changes.shown_totals(before)) == totals(votes.hourly_votes(first))
    gone = first.filter("query = 'q'")
    after = changes.moved_totals(before, changes.vote_changes(changes.changes_of(none, gone)))
    assert totals(changes.shown_totals(after)) == totals(votes.hourly_votes(first.filter("query = 'r'")))
    assert after.filter("posts = 0").count() == 1


@pytest.mark.parametrize("bounds", ["half_open", "open"])
def test_totals_follow_any_run_of_batches(spark, posts, tmp_path, bounds):
    draw = random.Random(3)
    posts_path, totals_path = str(tmp_path / "p"), str(tmp_path / "t")
    for batch in range(3):
        rows = posts(*[(draw.choice("qrs"), f"2024-01-0{draw.randint(1, 3)} {draw.randint(0, 3):02}:"
                        f"{draw.choice(['00', '30'])}:00", f"d{draw.randint(0, 9)}",
                        draw.randint(0, 9), draw.randint(0, 9)) for _ in range(40)])
        for _ in range(2 if batch % 2 else 1):  # the last batch may be stored again
            upkeep.upsert_posts(rows, posts_path, totals_path, batch, bounds=bounds)
        if batch == 1:
            tables.compact(spark, posts_path, schemas.POST, schemas.POST_KEY)
            tables.compact(spark, totals_path, schemas.VOTE_TOTALS, schemas.VOTE_KEY)
        want = totals(votes.hourly_votes(read_posts(spark, posts_path), bounds=bounds))
        assert totals(upkeep.read_totals(spark, totals_path)) == want


def test_a_batch_that_failed_between_the_tables_is_stored_again(spark, posts, tmp_path, monkeypatch):
    posts_path, totals_path = str(tmp_path / "p"), str(tmp_path / "t")
    upkeep.upsert_posts(posts(("q", "2024-01-01 10:10:00", "a", 5, 1)), posts_path, totals_path, 0)
    change = posts(("q", "2024-01-01 10:10:00", "a", 9, 1))
    write = tables.write_batch

    def fail(rows, path, *rest):
        if path == totals_path:
            raise OSError("lost")
        write(rows, path, *rest)

    monkeypatch.setattr(tables, "write_batch", fail)
    with pytest.raises(OSError):
        upkeep.upsert_posts(change, posts_path, totals_path, 1)
    monkeypatch.setattr(tables, "write_batch", write)
    upkeep.upsert_posts(change, posts_path, totals_path, 1)
    assert [r.ups for r in upkeep.read_totals(spark, totals_path).collect()] == [9]


def by_day_rows(spark, *rows):
    full = [(q, datetime.fromisoformat(at), d, "s", "a title", "/p/" + d, "u", "ann", ups, 0)
            for q, at, d, ups in rows]
    return spark.createDataFrame(full, schemas.POST)


@pytest.fixture(scope="module")
def by_day(spark, tmp_path_factory):
    """A compacted table of thirty days and twelve topics, and later rows."""
    path = str(tmp_path_factory.mktemp("by-day") / "days")
    start = datetime(2024, 1, 1, 12)
    tables.write_batch(by_day_rows(spark, *[
        (f"q{i % 12}", str(start + timedelta(days=i % 30, minutes=i)), f"d{i}", i % 7)
        for i in range(360)]), path, 0)
    tables.compact(spark, path, schemas.POST, schemas.POST_KEY)
    tables.write_batch(by_day_rows(spark, ("q1", "2024-01-30 23:00:00", "new", 3),
                                   ("q1", str(start + timedelta(days=1, minutes=1)), "d1", 99)),
                       path, 1)
    return path


@pytest.mark.parametrize("limit", [tables.BROADCAST_BYTES, 0])
def test_keys_read_alone_are_as_in_the_whole_table(spark, by_day, limit):
    whole = read_posts(spark, by_day)
    keys = whole.filter("ups > 4").select(*schemas.POST_KEY)
    got = tables.read_keys(spark, by_day, schemas.POST, schemas.POST_KEY, keys, limit=limit)
    assert sorted(got.collect()) == sorted(whole.join(keys, list(schemas.POST_KEY), "left_semi").collect())
    topics = spark.createDataFrame([("q1",), ("q5",), ("none",), ("q1",)], "query string")
    got = tables.read_keys(spark, by_day, schemas.POST, schemas.POST_KEY, topics, limit=limit)
    assert sorted(got.collect()) == sorted(whole.filter("query in ('q1', 'q5')").collect())
    assert {r.ups for r in got.filter("doc_id = 'd1'").collect()} == {99}
    none = tables.read_keys(spark, by_day, schemas.POST, schemas.POST_KEY, keys.limit(0), limit=limit)
    assert none.count() == 0


def files_read(df) -> int:
    """Files that the scan of a compacted folder has read, by its metric."""
    df.collect()
    found = []

    def visit(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan())
        if hasattr(node, "plan") and name.endswith("QueryStageExec"):
            return visit(node.plan())
        if name == "FileSourceScanExec" and "bucket" in node.toString():
            found.append(node.metrics().apply("numFiles").value())
        for i in range(node.children().size()):
            visit(node.children().apply(i))

    visit(df._jdf.queryExecution().executedPlan())
    return sum(found)


def test_keys_prune_buckets_and_days_at_run_time(spark, by_day):
    whole = read_posts(spark, by_day)
    every = files_read(whole)
    keys = whole.filter("doc_id in ('d3', 'd33')").select(*schemas.POST_KEY)  # of one day
    keys = spark.createDataFrame(keys.collect(), keys.schema)
    made = tables.read_keys(spark, by_day, schemas.POST, schemas.POST_KEY, keys)
    assert "dynamicpruning" in plan(made)
    assert files_read(made) <= 8 < 60 <= every
    topic = spark.createDataFrame([("q3",)], "query string")
    made = tables.read_keys(spark, by_day, schemas.POST, schemas.POST_KEY, topic)
    assert "dynamicpruning" in plan(made) and files_read(made) <= every / 2


def test_a_write_looks_at_its_own_lines_only(spark, posts, tmp_path, monkeypatch):
    path, rows, read = str(tmp_path / "t"), posts(("q", "2024-01-01", "a")), []
    real = tables._entries
    monkeypatch.setattr(tables, "_entries",
                        lambda spark, path, under="": read.append(under) or real(spark, path, under))
    for batch in (0, 1, 2, 2, 3):
        tables.write_batch(rows, path, batch, run="r")
    assert read == ["/run=r/batch_id=2"]
    assert len(tables.live_entries(spark, path)) == 4


@pytest.mark.parametrize("k, days", [(10, 1), (20, 2), (30, 4), (500, 30)])
def test_the_feed_reads_the_newest_days_only(spark, by_day, monkeypatch, k, days):
    want = feed.top_feed(read_posts(spark, by_day), k=k).collect()
    asked = []
    read = tables.read_table
    monkeypatch.setattr(tables, "read_table",
                        lambda *a, **kw: asked.append(kw["days"]) or read(*a, **kw))
    got = pages.newest_feed(spark, by_day, k=k).collect()
    assert got == want
    stored = tables.stored_days(spark, by_day)
    assert len(stored) == 30
    oldest = asked[-1][0]
    assert sum(d >= (oldest or stored[-1]) for d in stored) == days


def test_the_feed_by_days_goes_back_past_seen_and_untitled_posts(spark, by_day, posts, tmp_path):
    topics = spark.createDataFrame([("q1",), ("q7",)], "query string")
    seen = read_posts(spark, by_day).filter("created_utc > '2024-01-20'").select("doc_id")
    want = feed.top_feed(read_posts(spark, by_day), topics, seen).collect()
    assert pages.newest_feed(spark, by_day, topics, seen).collect() == want
    path = str(tmp_path / "flat")  # not compacted: no days to go by
    tables.write_batch(posts(("q", "2024-01-01", "a"), ("q", "2024-01-03", "b"),
                             ("r", "2024-01-03", "b")), path, 0)
    assert [r.doc_id for r in pages.newest_feed(spark, path).orderBy("rank").collect()] == ["b", "a"]
    assert pages.newest_feed(spark, path, topics).count() == 0


def test_rows_written_since_meet_only_old_rows_of_their_keys(spark, posts, tmp_path):
    path = str(tmp_path / "t")
    rows = [(f"q{i % 7}", f"2024-01-{1 + i % 20:02} 10:00:00", f"d{i}", i, 0) for i in range(300)]
    tables.write_batch(posts(*rows), path, 0)
    tables.compact(spark, path, schemas.POST, schemas.POST_KEY)
    again = [(*r[:3], 1000, 1) for r in rows[::30]]
    tables.write_batch(posts(*again, again[0], ("q1", None, "d1"), ("new", *rows[0][1:])), path, 1)
    read = lambda **more: tables.read_table(spark, path, schemas.POST, schemas.POST_KEY, **more)
    want = sorted(map(repr, read().collect()))
    shuffled = read(limit=0)
    assert len(want) == 302 and sorted(map(repr, shuffled.collect())) == want
    assert "LeftAnti" not in plan(shuffled)  # that would shuffle every old row
    marked = lookup.marked_by_bitmap(posts(*rows), posts(*again), ["query", "doc_id"], "known")
    assert 10 <= marked.filter("known").count() < 100
    # What was compacted is merged with what came later, again in one shuffle.
    tables.compact(spark, path, schemas.POST, schemas.POST_KEY)
    assert len(tables.live_entries(spark, path)) == 1
    assert sorted(map(repr, read().collect())) == want
