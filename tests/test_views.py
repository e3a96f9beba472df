"""The inputs of the registered queries, at sizes beyond a task."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks import queries, views
from phrasetide.session import new_work_dir, path_exists


def test_files_of_a_stream_grow_in_number_not_in_size(spark, posts, monkeypatch):
    rows = posts(*[("q", "2024-01-01", f"d{i}") for i in range(400)])
    monkeypatch.setattr(views, "posts", lambda *_: rows)
    for size, each in ((1, 1), (10 * queries._FILE_BYTES, 3)):
        monkeypatch.setattr(views, "posts_bytes", lambda *_: size)
        for by in ("doc_id", "query"):
            path, got = queries._post_files(spark, "", by)
            files = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
            assert got == each and sum(r["count"] for r in files) == 400
            assert each == 1 or max(r["count"] for r in files) < 300


def test_the_query_of_posts_shown_once_has_no_state_store(spark, posts, monkeypatch):
    rows = posts(*[(q, "2024-01-01", f"d{i}") for i in range(30) for q in "fcahb"[i % 3:]])
    folders = []
    monkeypatch.setattr(views, "posts", lambda *_: rows)
    monkeypatch.setattr(views, "posts_bytes", lambda *_: 1)
    monkeypatch.setattr(queries, "new_work_dir", lambda spark, label: folders.append(
        new_work_dir(spark, label)) or folders[-1])
    got = queries.QUERIES["stream_shown_once"](spark, "").collect()
    assert sorted((r.doc_id, r.query) for r in got) == sorted((f"d{i}", "a") for i in range(30))
    checkpoint = next(f for f in folders if "/checkpoint-" in f)
    assert path_exists(spark, f"{checkpoint}/offsets")
    assert not path_exists(spark, f"{checkpoint}/state")


def test_events_of_one_file_are_made_into_posts_by_all_cores(spark, tmp_path):
    spark.createDataFrame(
        [(i, datetime(2024, 1, 1), i, "view", 2.0, "{}") for i in range(50)],
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
        "props string").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    spark.createDataFrame([(i, f"name {i}") for i in range(20)], "p_partkey bigint, p_name string") \
        .coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    made = views.event_posts(spark, str(tmp_path))
    assert made.count() == 50
    assert made.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
