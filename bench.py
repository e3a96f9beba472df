"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from datetime import timedelta
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from checks import views  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from phrasetide import schemas  # noqa: E402
from phrasetide.operators import ingest  # noqa: E402
from phrasetide.operators.feed import top_feed  # noqa: E402
from phrasetide.plans.pages import newest_feed  # noqa: E402
from phrasetide.session import build_session, new_work_dir  # noqa: E402
from phrasetide.sources import registry, tables  # noqa: E402
from phrasetide.sources.topic import FolderTopic  # noqa: E402
from phrasetide.streaming.feed import start_feed  # noqa: E402
from phrasetide.streaming.metrics import ProgressLog  # noqa: E402
from phrasetide.streaming.posts import read_delays, start_posts  # noqa: E402

HEADLINE = (
    "ingest_messages", "dedup_messages", "percolate_matches", "percolate_documents",
    "percolate_counts", "percolate_shuffled", "posts_table", "posts_table_documents",
    "hourly_votes", "series_percent", "trailing_5min", "feed_newest2", "feed_since",
    "feed_poll", "feed_top10", "posts_upsert", "keyed_since", "replay_slices", "stream_posts",
    "stream_hourly", "votes_from_changes", "scan_topics", "feed_top10_by_day", "series_grains",
    "paned_5min", "stream_panes", "stream_registrations",
)


# Messages in each micro-batch whose delay is taken, how many of them, and the
# seconds between two of them while the total delay is taken.
BATCH_MESSAGES, BATCHES, PAUSE = 2000, 6, 2


def delays(spark, sf_dir: str) -> dict[str, float]:
    """Seconds that a micro-batch takes, in the middle of a run (median)."""
    paths = {n: new_work_dir(spark, n) for n in (
        "values", "registry", "posts", "posts-ck", "files", "feed", "feed-ck")}
    messages = views.event_messages(spark, sf_dir).limit(BATCH_MESSAGES * BATCHES)
    topic = FolderTopic(paths["values"], files_per_batch=1)
    topic.publish(ingest.to_values(messages).repartition(BATCHES))
    topics = views.part_registry(spark, sf_dir).withColumnRenamed("query", "topic")
    registry.register(registry.registrations(topics, "2024-01-01 00:00:00"), paths["registry"])
    log = ProgressLog(spark)
    posts = start_posts(topic.stream(spark), paths["registry"], paths["posts"],
                        paths["posts-ck"], interval=None)
    posts.awaitTermination()
    views.posts(spark, sf_dir).limit(BATCH_MESSAGES * BATCHES).repartition(BATCHES).write.parquet(
        paths["files"])
    rows = (spark.readStream.schema(schemas.POST).option("maxFilesPerTrigger", 1)
            .parquet(paths["files"]))
    feed = start_feed(rows, views.word_topics(spark, sf_dir), paths["feed"], paths["feed-ck"],
                      interval=None)
    feed.awaitTermination()
    found = {}
    for name, query in (("posts", posts), ("feed", feed)):
        times = [r.duration_ms for r in log.table(query).orderBy("batch_id").collect()]
        found[f"{name}_batch_sec"] = median(times[1:] or times) / 1000
    log.close()
    found |= total_delays(spark, messages, paths["registry"])
    return found | table_reads(spark, sf_dir)


def total_delays(spark, messages, registry_path: str) -> dict[str, float]:
    """Seconds from publishing to storing while messages keep coming, by sketches."""
    values, stored, checkpoint, delays_path = (new_work_dir(spark, n) for n in (
        "live", "live-posts", "live-ck", "live-delays"))
    topic, query = FolderTopic(values), None
    for part in range(BATCHES):
        topic.publish(ingest.to_values(messages.filter(F.col("ups") % BATCHES == part)))
        query = query or start_posts(topic.stream(spark, published=True), registry_path, stored,
                                     checkpoint, interval="100 milliseconds",
                                     delays_path=delays_path)
        time.sleep(PAUSE)
    query.processAllAvailable()
    query.stop()
    found = read_delays(spark, delays_path, (0.5, 0.95)).collect()
    return {f"total_delay_p{round(100 * r.share)}_sec": r["value"] / 1000 for r in found}


def table_reads(spark, sf_dir: str) -> dict[str, float]:
    """Seconds that reads of a stored, compacted table take once it is there."""
    path = new_work_dir(spark, "bench-table")
    tables.write_batch(views.posts(spark, sf_dir), path, 0)
    tables.compact(spark, path, schemas.POST, schemas.POST_KEY)
    topics = views.word_topics(spark, sf_dir)
    topic = topics.agg(F.min("query")).first()[0]
    newest = views.posts(spark, sf_dir).agg(F.max("created_utc")).first()[0]
    reads = {
        "keyed_read_sec": lambda: tables.read_table(
            spark, path, schemas.POST, schemas.POST_KEY, topics=[topic],
            after=newest - timedelta(days=2)),
        "feed_by_day_sec": lambda: newest_feed(spark, path, topics),
        "feed_whole_sec": lambda: top_feed(
            tables.read_table(spark, path, schemas.POST, schemas.POST_KEY), topics),
    }
    found = {}
    for name, read in reads.items():
        start = time.perf_counter()
        read().write.format("noop").mode("overwrite").save()
        found[name] = round(time.perf_counter() - start, 3)
    return found


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    # The derived inputs (post lines, stored posts) are written before timing.
    events = views.table(spark, sf_dir, "events").count()
    views.posts(spark, sf_dir).count()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    out = {
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    if seconds.get("stream_posts"):
        out["stream_records_per_sec"] = round(events / seconds["stream_posts"])
    if len(sys.argv) == 1:
        out |= delays(spark, sf_dir)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
