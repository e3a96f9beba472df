from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from phrasetide.functions.numbers import synthetic_downs
from phrasetide.functions.times import from_epoch, to_epoch_text
from phrasetide.operators import ingest
from phrasetide.schemas import MESSAGE, REQUIRED_KEYS


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_projects_and_lowers(lines, line):
    row = only(ingest.read_messages(lines(line())))
    assert row.__fields__ == list(REQUIRED_KEYS)
    assert (row.title, row.author, row.url, row.subreddit) == \
        ("old york bridge", "ann", "http://ex.org/a1", "pics")


@pytest.mark.parametrize("key", REQUIRED_KEYS)
def test_missing_key_drops_the_line(lines, line, key):
    assert ingest.read_messages(lines(line(drop=(key,)))).count() == 0


def test_null_value_is_not_a_missing_key(lines, line):
    assert only(ingest.read_messages(lines(line(gilded=None, title=None)))).gilded is None


@pytest.mark.parametrize("bad", ["{broken", "", "[1]", "7"])
def test_malformed_line_fails(lines, line, bad):
    with pytest.raises(Exception, match="not a JSON object"):
        ingest.read_messages(lines(line(), bad)).collect()


@pytest.mark.parametrize("ups", [None, -1, "x", 2.5])
def test_bad_ups_fail_or_go_to_quarantine(lines, line, ups):
    given = lines(line(id="good"), line(id="bad", ups=ups))
    with pytest.raises(Exception, match="up-votes"):
        ingest.read_messages(given).collect()
    assert only(ingest.read_messages(given, "quarantine")).id == "good"
    assert only(ingest.rejected_lines(given)).reason == "up-votes missing or negative"


def test_quarantine_splits_lines_three_ways(lines, line):
    given = lines(line(), "{broken", line(drop=("score",)), "{}")
    assert ingest.read_messages(given, "quarantine").count() == 1
    assert only(ingest.rejected_lines(given)).line == "{broken"


def test_unknown_mode_is_refused(lines, line):
    with pytest.raises(ValueError):
        ingest.read_messages(lines(line()), "ignore")


def test_created_utc_number_and_text_agree(lines, line):
    messages = ingest.read_messages(lines(line(created_utc=1704103200), line(created_utc="1704103200"),
                                          line(created_utc=1704103200.0)))
    assert messages.select(from_epoch("created_utc")).distinct().count() == 1


def test_epoch_text_keeps_microseconds(spark):
    df = spark.sql("select timestamp '2024-01-01 00:00:11.172425' as t")
    row = df.select("t", to_epoch_text("t").alias("s")) \
            .select("t", "s", from_epoch("s").alias("back")).first()
    assert row.s == "1704067211.172425" and row.t == row.back


@pytest.mark.parametrize("value, kept", [
    (False, True), (0, True), (0.0, True), (True, False), (1, False), (None, False),
    ("false", False), ("", False)])
def test_over_18(lines, line, value, kept):
    messages = ingest.read_messages(lines(line(over_18=value)))
    assert ingest.safe_only(messages).count() == int(kept)


def test_downs_spread_over_zero_to_ups(spark):
    df = spark.range(4000).select(F.col("id").cast("string").alias("id"), F.lit(3).alias("ups"))
    seen = {r.d: r.n for r in df.groupBy(synthetic_downs("id", "ups").alias("d"))
            .agg(F.count("*").alias("n")).collect()}
    assert set(seen) == {0, 1, 2, 3} and min(seen.values()) > 800


def test_same_id_twice_is_one_row(lines, line):
    given = ingest.read_messages(lines(
        line(created_utc=20, title="b"), line(created_utc=9, title="z"), line(created_utc=9, title="c")))
    row = only(ingest.keep_one_per_id(given))
    assert (row.created_utc, row.title) == ("9", "c")


def test_values_round_trip_with_nulls(lines, line):
    messages = ingest.read_messages(lines(line(gilded=None), line(id="b2", over_18=None)))
    values = ingest.to_values(messages)
    assert '"gilded":null' in values.filter(F.contains("value", F.lit("a1"))).first().value
    back = ingest.from_values(values)
    assert back.schema.simpleString() == MESSAGE.simpleString()
    assert sorted(back.collect()) == sorted(messages.collect())


def test_empty_object_is_dropped(spark):
    assert ingest.from_values(spark.createDataFrame([("{}",)], "value string")).count() == 0


def test_to_posts_casts(spark, lines, line):
    matched = ingest.read_messages(lines(line())).withColumn("query", F.lit("york"))
    row = only(ingest.to_posts(matched))
    assert (row.query, row.doc_id, row.ups) == ("york", "a1", 7)
    assert row.created_utc.isoformat() == "2024-01-01T10:00:00"
