from __future__ import annotations

import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from phrasetide import schemas
from phrasetide.plans.hourly import total_votes
from phrasetide.session import new_work_dir, shared_dir
from phrasetide.sources import registry as reg
from phrasetide.sources import replay, tables
from phrasetide.sources.files import read_lines, spread
from phrasetide.sources.topic import FolderTopic, KafkaTopic
from phrasetide.streaming.posts import start, store


def read_posts(spark, path):
    return tables.read_table(spark, path, schemas.POST, schemas.POST_KEY)


def test_newest_batch_wins_and_replay_changes_nothing(spark, posts, tmp_path):
    path = str(tmp_path / "t")
    tables.write_batch(posts(("q", "2024-01-01", "a", 1, 0), ("q", "2024-01-01", "b", 1, 0)), path, 0)
    change = posts(("q", "2024-01-01", "a", 7, 0))
    for _ in range(2):
        tables.write_batch(change, path, 1)
        assert sorted((r.doc_id, r.ups) for r in read_posts(spark, path).collect()) == \
            [("a", 7), ("b", 1)]
    tables.write_batch(posts(("q", "2024-01-01", "a", 3, 0)), path, 0)
    assert [(r.doc_id, r.ups) for r in read_posts(spark, path).collect()] == [("a", 7)]


def test_same_second_posts_are_both_kept(spark, posts, tmp_path):
    path = str(tmp_path / "t")
    tables.write_batch(posts(("q", "2024-01-01", "a"), ("q", "2024-01-01", "b")), path, 0)
    assert read_posts(spark, path).count() == 2


def test_compaction_in_place_keeps_what_is_written_meanwhile(spark, posts, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for batch in range(3):
        tables.write_batch(posts(*[("q", "2024-01-01", f"d{i}", batch, 0) for i in range(batch, 5)]),
                           path, batch)
    before = sorted(read_posts(spark, path).collect())
    read = tables.read_table

    def meanwhile(*args, **kw):
        rows = read(*args, **kw)
        monkeypatch.setattr(tables, "read_table", read)
        tables.write_batch(posts(("q", "2024-01-02", "new")), path, 0, run="other")
        return rows

    monkeypatch.setattr(tables, "read_table", meanwhile)
    tables.compact(spark, path, schemas.POST, schemas.POST_KEY)
    got = sorted(read_posts(spark, path).collect())
    assert [r for r in got if r.doc_id != "new"] == before and len(got) == len(before) + 1
    tables.write_batch(posts(("q", "2024-01-01", "d0", 9, 0)), path, 1, run="other")
    assert {r.doc_id: r.ups for r in read_posts(spark, path).collect()}["d0"] == 9
    assert len(tables.live_entries(spark, path)) == 3


def test_runs_with_the_same_numbers_do_not_replace_each_other(spark, posts, tmp_path):
    path = str(tmp_path / "t")
    tables.write_batch(posts(("q", "2024-01-01", "a")), path, 0, run="one")
    tables.write_batch(posts(("q", "2024-01-01", "b")), path, 0, run="two")
    assert sorted(r.doc_id for r in read_posts(spark, path).collect()) == ["a", "b"]


def test_a_reader_goes_on_while_its_batch_is_written_again(spark, posts, tmp_path):
    path = str(tmp_path / "t")
    tables.write_batch(posts(("q", "2024-01-01", "a")), path, 0)
    reader = read_posts(spark, path)
    tables.write_batch(posts(("q", "2024-01-01", "a", 5, 0)), path, 0)
    assert [r.ups for r in reader.collect()] == [1]
    assert [r.ups for r in read_posts(spark, path).collect()] == [5]


@pytest.mark.parametrize("compacted", [False, True])
def test_reading_by_topic_and_time(spark, posts, tmp_path, compacted):
    path = str(tmp_path / "t")
    tables.write_batch(posts(("q", "2024-01-01", "a"), ("q", "2024-01-03", "b"),
                             ("r", "2024-01-03", "c")), path, 0)
    if compacted:
        tables.compact(spark, path, schemas.POST, schemas.POST_KEY)
    tables.write_batch(posts(("q", "2024-01-04", "d"), ("q", "2024-01-03", "b", 7, 0)), path, 1)
    rows = tables.read_table(spark, path, schemas.POST, schemas.POST_KEY, topics=["q"],
                             after="2024-01-02")
    assert sorted((r.doc_id, r.ups) for r in rows.collect()) == [("b", 7), ("d", 1)]


def test_registering_twice_keeps_the_first_time(spark, tmp_path):
    path = str(tmp_path / "r")
    topics = spark.createDataFrame([("a",), ("a",), ("b",)], "topic string")
    reg.register(reg.registrations(topics, "2024-01-01"), path)
    reg.register(reg.registrations(topics.limit(1), "2024-02-01"), path)
    known = reg.read_registry(spark, path)
    assert sorted((r.query, r.registered_at.month) for r in known.collect()) == [("a", 1), ("b", 1)]
    assert reg.registered_by(known, "2023-01-01").count() == 0
    before = sorted(known.collect())
    reg.compact(spark, path)
    assert sorted(reg.read_registry(spark, path).collect()) == before
    assert len(tables.live_entries(spark, path)) == 1


def test_scan_of_registered_queries(posts, registry):
    rows = posts(("q", "2024-01-01", "a"), ("r", "2024-01-01", "b"))
    got = tables.scan_posts(rows, ["query", "doc_id"], registry("q", "q")).collect()
    assert [tuple(r) for r in got] == [("q", "a")]


def test_votes_job(spark, posts, tmp_path):
    at, known, out = (str(tmp_path / n) for n in ("posts", "registry", "votes"))
    tables.write_batch(posts(("q", "2024-01-01 00:10:00", "a", 2, 1),
                             ("x", "2024-01-01 00:10:00", "a", 2, 1)), at, 0)
    reg.register(reg.registrations(spark.createDataFrame([("q",)], "topic string"), "2024-01-01"),
                 known)
    for _ in range(2):
        total_votes(spark, at, known, out, 0)
    got = tables.read_table(spark, out, schemas.VOTES, schemas.VOTE_KEY).collect()
    assert [(r.query, r.ups, r.downs) for r in got] == [("q", 2, 1)]


def test_numbering_equals_a_global_window(spark):
    df = spark.range(5000).select(F.expr("id * 7919 % 1000").alias("k"), "id").repartition(7)
    want = df.withColumn("n", F.row_number().over(Window.orderBy("k", "id")))
    got = replay.number_rows(df, ["k", "id"])
    assert got.exceptAll(want.select(got.columns)).count() == 0 and got.count() == 5000


def test_first_slice_is_one_short(spark):
    sliced = replay.slices(spark.range(3000), ["id"])
    got = sorted((r.slice_id, r.n) for r in replay.slice_sizes(sliced).collect())
    assert got == [(0, 1249), (1, 1250), (2, 501)]


def test_slices_are_replayed_in_order(spark, tmp_path):
    path, topic = str(tmp_path / "slices"), FolderTopic(str(tmp_path / "topic"), files_per_batch=1)
    replay.write_slices(replay.slices(spark.range(30), ["id"], 10), path)
    assert replay.replay(spark, path, topic, pause=0) == 4
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")
    query = start(topic.stream(spark), store(out, checkpoint), checkpoint, interval=None)
    query.awaitTermination()
    rows = tables.read_batches(spark, out, StructType.fromDDL("value string")).collect()
    got = [sorted(json.loads(r.value)["id"] for r in rows if r.batch_id == n) for n in range(4)]
    assert got == [[*range(9)], [*range(9, 19)], [*range(19, 29)], [29]]
    assert replay.replay(spark, path, topic, pause=0, first=4) == 4


def test_slices_are_replayed_several_a_turn(spark, tmp_path):
    path, topic = str(tmp_path / "slices"), FolderTopic(str(tmp_path / "topic"), files_per_batch=1)
    replay.write_slices(replay.slices(spark.range(1000), ["id"], 10), path)
    assert replay.turn_slices(spark, path) == 13
    assert replay.replay(spark, path, topic, pause=0, slices=13) == 101
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")
    start(topic.stream(spark), store(out, checkpoint), checkpoint, interval=None).awaitTermination()
    rows = tables.read_batches(spark, out, StructType.fromDDL("value string")).collect()
    got = [sorted(json.loads(r.value)["id"] for r in rows if r.batch_id == n) for n in range(9)]
    assert sum(got, []) == [*range(1000)]
    assert [len(ids) for ids in got] == [129, 130, 130, 130, 130, 130, 130, 91, 0]


def test_lines_of_subfolders_are_read(spark, tmp_path):
    for n, folder in enumerate(("", "a", "a/b")):
        (tmp_path / "in" / folder).mkdir(exist_ok=True)
        (tmp_path / "in" / folder / "f.txt").write_text(f"line {n}\n")
    assert read_lines(spark, str(tmp_path / "in")).count() == 3


def test_topics(spark, tmp_path):
    topic = FolderTopic(str(tmp_path / "topic"))
    values = spark.createDataFrame([("{}",)], "value string")
    topic.publish(values)
    topic.publish(values)
    assert read_lines(spark, topic.path).count() == 2
    kafka = KafkaTopic(("b1:9092", "b2:9092"), "posts", offsets_per_batch=1250)
    assert kafka.read_options() == {
        "kafka.bootstrap.servers": "b1:9092,b2:9092", "subscribe": "posts",
        "startingOffsets": "latest", "maxOffsetsPerTrigger": "1250"}
    assert kafka.write_options()["topic"] == "posts"


def test_spread_only_touches_scans_of_few_files(spark, tmp_path):
    few, many = str(tmp_path / "few"), str(tmp_path / "many")
    spark.range(100).coalesce(1).write.parquet(few)
    spark.range(100).repartition(8).write.parquet(many)
    assert "Exchange" in spread(spark.read.parquet(few))._jdf.queryExecution().toString()
    assert "Exchange" not in spread(spark.read.parquet(many))._jdf.queryExecution().toString()


def test_work_dirs_are_under_the_shared_folder(spark):
    one, two = new_work_dir(spark, "x"), new_work_dir(spark, "x")
    assert one != two and one.startswith(shared_dir(spark))
