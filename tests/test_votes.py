from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from phrasetide.functions.numbers import percent_label
from phrasetide.operators import votes


def hours(df):
    return sorted((r.query, r.time_utc.strftime("%d %H"), r.ups, r.downs) for r in df.collect())


def test_post_on_the_hour(posts):
    rows = posts(("q", "2024-01-01 10:00:00", "a", 5, 1), ("q", "2024-01-01 10:59:59", "b", 3, 2))
    assert hours(votes.hourly_votes(rows)) == [("q", "01 10", 8, 3)]
    assert hours(votes.hourly_votes(rows, bounds="open")) == [("q", "01 10", 3, 2)]
    with pytest.raises(ValueError):
        votes.hourly_votes(rows, bounds="closed")


def test_hours_without_posts_have_no_row(posts):
    rows = posts(("q", "2024-01-01 10:30:00", "a"), ("q", "2024-01-01 13:30:00", "b"))
    assert [h for _, h, *_ in hours(votes.hourly_votes(rows))] == ["01 10", "01 13"]


def test_first_hour_and_registered_queries(posts, registry):
    rows = posts(("q", "2006-12-31 23:59:59", "a"), ("q", "2007-01-01 00:00:01", "b"),
                 ("r", "2007-01-01 00:00:01", "c"))
    assert len(hours(votes.hourly_votes(rows, registry("q", "q", "z")))) == 1
    assert len(hours(votes.hourly_votes(rows, first_hour=None))) == 3


def series_of(spark, *rows):
    return spark.createDataFrame(list(rows), "query string, ts_ms long, ups long, total long")


def test_series_rows(posts):
    rows = votes.hourly_votes(posts(("q", "2024-01-01 11:30:00", "a", 2, 3),
                                    ("q", "2024-01-01 10:30:00", "b", 1, 0),
                                    ("r", "2024-01-01 10:30:00", "b", 1, 0)))
    got = [tuple(r) for r in votes.topic_series(rows, "q").collect()]
    assert got == [("q", 1704103200000, 1, 1), ("q", 1704106800000, 2, 5)]


def test_arrays_are_ordered_and_kept_when_empty(spark, registry):
    rows = series_of(spark, ("q", 2, 20, 21), ("q", 1, 10, 11))
    got = {r.query: [tuple(p) for p in r.data]
           for r in votes.series_arrays(rows, registry("q", "none"), "total").collect()}
    assert got == {"q": [(1, 11), (2, 21)], "none": []}


def test_percent_base_is_the_first_non_zero_value(spark):
    rows = series_of(spark, ("q", 1, 0, 0), ("q", 2, 4, 4), ("q", 3, 5, 5), ("z", 1, 0, 0))
    got = {(r.query, r.ts_ms): (r.pct, r.label) for r in votes.series_percent(rows).collect()}
    assert got == {("q", 1): (-100.0, "-100%"), ("q", 2): (0.0, "0%"),
                   ("q", 3): (25.0, " + 25%"), ("z", 1): (None, None)}


def test_percent_covers_the_visible_range_only(spark):
    day = 86400000
    rows = series_of(spark, ("q", 0, 1, 1), ("q", 365 * day, 2, 2), ("q", 366 * day, 3, 3))
    got = sorted((r.ts_ms // day, r.pct) for r in votes.series_percent(rows).collect())
    assert got == [(365, 0.0), (366, 50.0)]
    assert votes.series_percent(rows, span=None).count() == 3


def test_percent_label(spark):
    df = spark.createDataFrame([(12.34,), (0.04,), (-5.0,), (100.0,)], "v double")
    assert [r[0] for r in df.select(percent_label(F.col("v"))).collect()] == \
        [" + 12.3%", "0%", "-5%", " + 100%"]


def test_trailing_counts_equal_brute_force(spark, posts):
    at = [0, 1, 1, 299, 300, 301, 599, 600, 601, 1200]
    rows = posts(*[("q", str(datetime.utcfromtimestamp(1704067200 + s)), f"d{i}")
                   for i, s in enumerate(at)])
    got = {int(r.until_utc.timestamp() if r.until_utc.tzinfo else
               (r.until_utc - datetime(2024, 1, 1)).total_seconds()): r.n
           for r in votes.trailing_counts(rows).collect()}
    assert got == {s: sum(1 for x in at if s - 300 <= x <= s) for s in set(at)}


def test_few_seconds_are_looked_back_on_from_two_slices(posts):
    rows = posts(*[("q", f"2024-01-01 {h}:{m:02}:{s:02}", f"d{h}-{m}-{s}")
                   for h in (10, 11) for m in range(60) for s in (0, 20, 40)])
    got = {r.until_utc.strftime("%H:%M:%S"): r.n for r in votes.trailing_counts(rows).collect()}
    assert len(got) == 360 and got["10:00:40"] == 3 and got["11:00:00"] == got["11:05:00"] == 16
    # Of an hour, a slice, only the last five minutes.
    assert votes._in_slices(votes._per_second(rows), 300).count() == 360 + 2 * 15


def test_count_at_cursor(spark, posts):
    rows = posts(("q", "2024-01-01 00:00:00", "a"), ("q", "2024-01-01 00:05:00", "b"),
                 ("q", "2024-01-01 00:05:01", "c"), ("r", "2024-01-01 00:05:00", "d"))
    cursor = spark.sql("select 'q' as query, timestamp '2024-01-01 00:05:00' as lasttime "
                       "union all select 'r', null")
    for limit in (None, 0):
        extra = {} if limit is None else {"limit": limit}
        assert [(r.query, r.n) for r in votes.count_at(rows, cursor, **extra).collect()] == [("q", 2)]


def test_sliding_counts_and_instants(posts):
    rows = posts(("q", "2024-01-01 00:07:30", "a"), ("q", "2024-01-01 00:07:30", "b"))
    got = sorted((r.until_utc.minute, r.n) for r in votes.sliding_counts(rows).collect())
    assert got == [(8, 2), (9, 2), (10, 2), (11, 2), (12, 2)]
    assert votes.distinct_instants(rows).count() == 1
