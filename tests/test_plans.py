"""The plans Spark makes of the operators."""

from __future__ import annotations

import re

import pytest

from phrasetide.operators import feed, ingest, percolate, votes
from phrasetide.plans.digest import digest
from phrasetide.schemas import MESSAGE, POST, POST_KEY
from phrasetide.sources import tables
from phrasetide.sources.files import read_lines


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def message_table(spark, lines, line, tmp_path):
    ingest.read_messages(lines(line())).write.parquet(str(tmp_path / "m"))
    return spark.read.schema(MESSAGE).parquet(str(tmp_path / "m"))


@pytest.fixture
def post_table(spark, posts, tmp_path):
    posts(("q", "2024-01-01", "a")).write.parquet(str(tmp_path / "p"))
    return spark.read.schema(POST).parquet(str(tmp_path / "p"))


def test_no_python_in_the_plans(message_table, post_table, registry):
    for df in (digest(message_table, registry("york")), votes.hourly_votes(post_table),
               feed.newest(post_table), feed.render(feed.top_feed(post_table)),
               votes.trailing_counts(post_table)):
        assert not re.search("Python|Cartesian|BroadcastNestedLoop", plan(df))


def test_small_registry_matches_without_a_shuffle_of_posts(message_table, registry):
    text = plan(percolate.percolate(message_table, registry("york", "old york bridge now")))
    posts_side = text[:text.index("BroadcastExchange")]
    assert "BroadcastHashJoin" in posts_side and "Exchange" not in posts_side
    # The explode is part of the generated stage of the join and has no
    # filter on its size below it, which would tokenise once per token.
    assert "Generate explode(_grams" in posts_side and "size(array_distinct" not in text


def test_large_registry_is_an_equi_join_of_offers_made_once(message_table, registry, monkeypatch):
    offers, made = [], percolate._offers
    monkeypatch.setattr(percolate, "_offers", lambda rows: offers.append(rows) or made(rows))
    text = plan(percolate.percolate(message_table, registry("york", "a b c d"), limit=0))
    assert re.search(r"(SortMergeJoin|HashJoin) \[gram#\d+\], \[gram#\d+\]", text)
    # The offers are written once; the posts are scanned to join the pairs back to.
    assert len(offers) == 1
    assert len(re.findall(r"FileScan parquet \[id#\d+,gram#", text)) == 1
    assert len(re.findall(r"FileScan parquet \[id#\d+,title#", text)) == 1
    # Before its shuffle every gram meets the hashes of those that phrases are filed under.
    assert re.search(r"BroadcastHashJoin \[_hash#\d+L?\], \[_hash#\d+L?\], LeftSemi", plan(offers[0]))


@pytest.mark.parametrize("limit, passing", [(None, 51), (40_000, 51), (4096, 60), (10, 50 * 7)])
def test_unknown_grams_are_gone_before_the_exchange(lines, line, registry, limit, passing):
    posts = ingest.read_messages(lines(*[line(id=str(i), title=f"old york bridge {i}")
                                         for i in range(50)]))
    others = [f"none{i}" for i in range(98)]
    index = percolate.index_phrases(percolate.phrases(registry("york", "bridge 7", *others)), limit=0)
    offered = percolate._offer(posts.select("id", "title"), "title", index).select("id", "gram")
    known = percolate._known_grams(offered, index, limit)
    assert known.columns == ["id", "gram"] and 51 <= known.count() and (
        known.count() <= passing or limit == 10)
    found = {(r.id, r.gram) for r in known.collect()}
    assert {(str(i), "york") for i in range(50)} | {("7", "bridge 7")} <= found
    assert ("_bits" in plan(known)) == (limit == 4096)


def test_only_grams_of_the_index_are_shuffled(spark, lines, line, registry):
    posts = ingest.read_messages(lines(*[line(id=str(i), title=f"old york bridge {i}")
                                         for i in range(50)]))
    index = percolate.index_phrases(percolate.phrases(registry("york", "bridge 7")), limit=0)
    offered = percolate._offer(posts.select("id", "title"), "title", index).select("id", "gram")
    assert offered.count() >= 50 * 7
    assert percolate._known_grams(offered, index).count() == 51


@pytest.mark.parametrize("heavy", [0, 10])
def test_heavy_grams_give_the_same_matches(lines, line, registry, monkeypatch, heavy):
    posts = ingest.read_messages(lines(*[line(id=str(i), title=f"old york bridge {i}")
                                         for i in range(20)]))
    queries = registry("york", "bridge 7", "old york", "none")
    want = sorted((r.id, r.query) for r in percolate.percolate(posts, queries).collect())
    monkeypatch.setattr(percolate, "HEAVY_POSTS", heavy)
    got = percolate.percolate(posts, queries, limit=0).collect()
    assert sorted((r.id, r.query) for r in got) == want and len(want) == 41


@pytest.fixture
def sources(spark, lines, line, message_table, tmp_path):
    """The same posts as a table, as text lines and as topic values."""
    path = str(tmp_path / "lines")
    lines(line(), line(id="b2")).withColumnRenamed("line", "value").write.text(path)
    ingest.to_values(message_table).write.text(str(tmp_path / "values"))
    return {"table": lambda: message_table,
            "lines": lambda: ingest.read_messages(read_lines(spark, path)),
            "values": lambda: ingest.from_values(spark.read.text(str(tmp_path / "values")))}


@pytest.mark.parametrize("source", ["table", "lines", "values"])
def test_digest_reads_and_shuffles_posts_once(sources, registry, source):
    made = digest(sources[source](), registry("york", "bridge"))
    assert made.count() > 0
    made.collect()
    final = plan(made).split("== Initial Plan ==")[0]
    by_id = [line for line in final.splitlines() if "Exchange hashpartitioning(id" in line]
    # The second use, for joining the posts back, reads the same shuffle again.
    assert sorted("ReusedExchange" in line for line in by_id) == [False, True]
    assert len(re.findall(r"FileScan (?:text|parquet)", final)) == 1


def test_votes_prune_columns_and_sum_before_the_shuffle(post_table):
    text = plan(votes.hourly_votes(post_table))
    assert "ReadSchema: struct<query:string,created_utc:timestamp,ups:bigint,downs:bigint>" in text
    assert "partial_sum" in text
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(created_utc", text)


def test_newest_limits_ranks_before_the_shuffle(post_table):
    text = plan(feed.newest(post_table))
    assert re.search(r"WindowGroupLimit .*Partial", text)


def test_topic_filter_reaches_the_scan(post_table):
    text = plan(feed.newest_of(post_table, "q"))
    assert "EqualTo(query,q)" in text and "TakeOrderedAndProject" in text


def test_top_feed_reads_recent_rows_only(post_table):
    text = plan(feed.top_feed(post_table))
    assert "TakeOrderedAndProject" in text
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(created_utc", text)


@pytest.mark.parametrize("made", [feed.since, feed.poll, votes.count_at])
def test_oldest_cursor_bounds_the_scan(spark, post_table, tmp_path, made):
    path = str(tmp_path / "cursor")
    spark.sql("select 'q' as query, timestamp '2024-01-01' as lasttime").write.parquet(path)
    text = plan(made(post_table, spark.read.parquet(path)))
    scans = [line for line in text.splitlines() if "PushedFilters" in line]
    assert any(re.search(r"GreaterThan(OrEqual)?\(created_utc", line) for line in scans)


def test_poll_scans_the_posts_once(spark, post_table, tmp_path):
    path = str(tmp_path / "cursor")
    spark.sql("select 'q' as query, timestamp '2024-01-01' as lasttime "
              "union all select 'r', null").write.parquet(path)
    assert plan(feed.poll(post_table, spark.read.parquet(path))).count("title:string") == 1


def test_a_compacted_table_is_read_by_partitions_without_a_shuffle(spark, posts, tmp_path):
    path = str(tmp_path / "t")
    tables.write_batch(posts(("q", "2024-01-01", "a"), ("r", "2024-01-05", "b")), path, 0)
    tables.compact(spark, path, POST, POST_KEY)
    rows = tables.read_table(spark, path, POST, POST_KEY, topics=["q"], after="2024-01-02")
    text = plan(rows)
    assert "Exchange" not in text and "Aggregate" not in text
    assert re.search(r"PartitionFilters: \[.*bucket#\d+.*day#\d+ >=", text)


def test_key_filters_reach_the_scan_of_a_keyed_table(spark, posts, tmp_path):
    path = str(tmp_path / "t")
    tables.write_batch(posts(("q", "2024-01-01", "a")), path, 0)
    rows = tables.read_table(spark, path, POST, POST_KEY).filter("query = 'q'")
    assert "EqualTo(query,q)" in plan(rows)


def test_keyed_table_reads_the_columns_asked_for(spark, posts, tmp_path):
    path = str(tmp_path / "t")
    tables.write_batch(posts(("q", "2024-01-01", "a")), path, 0)
    rows = tables.read_table(spark, path, POST, POST_KEY, ["ups"])
    assert "title" not in plan(rows) and rows.columns == ["query", "created_utc", "doc_id", "ups"]
