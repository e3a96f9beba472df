"""Hourly vote totals and the series drawn from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phrasetide.functions.numbers import percent_change, percent_label
from phrasetide.functions.times import to_millis
from phrasetide.operators.lookup import BROADCAST_BYTES, lookup_join, row_bytes

# Fixed value: posts before this hour are not totalled.
FIRST_HOUR = "2007-01-01 00:00:00"

HOUR_SECONDS = 3600
TRAILING_SECONDS = 300

# Length of a slice of trailing counts, in look-backs.
SLICE_SPANS = 12


def inside_hour(posts: DataFrame, at: str = "created_utc") -> DataFrame:
    """Drop posts that fall exactly on an hour (both ends of the hour are open)."""
    return posts.filter(F.col(at) != F.date_trunc("HOUR", at))


def since_first_hour(posts: DataFrame, first_hour: str | None) -> DataFrame:
    if first_hour is None:
        return posts
    return posts.filter(F.col("created_utc") >= F.lit(first_hour).cast("timestamp"))


def sum_votes(posts: DataFrame) -> DataFrame:
    """Votes per query and clock hour; ``posts`` may be a stream."""
    return (posts.select("query", "created_utc", "ups", "downs")
            .groupBy("query", F.window("created_utc", "1 hour").alias("w"))
            .agg(F.sum("ups").alias("ups"), F.sum("downs").alias("downs")))


def to_votes(summed: DataFrame) -> DataFrame:
    """Stamp each total with the start of its hour."""
    return summed.select("query", F.col("w.start").alias("time_utc"), "ups", "downs")


def counted_posts(posts: DataFrame, bounds: str = "half_open",
                  first_hour: str | None = FIRST_HOUR) -> DataFrame:
    """The posts that hourly totals count; ``posts`` may be a stream.

    ``bounds="open"`` counts a post that falls exactly on an hour nowhere,
    ``"half_open"`` in the hour it starts.
    """
    if bounds == "open":
        posts = inside_hour(posts)
    elif bounds != "half_open":
        raise ValueError(f"bounds must be 'open' or 'half_open', not {bounds!r}")
    return since_first_hour(posts, first_hour)


def of_registered(totals: DataFrame, registry: DataFrame | None) -> DataFrame:
    """Totals of registered queries; applied after summing, when each is small."""
    if registry is None:
        return totals
    return totals.join(registry.select("query").distinct(), "query", "left_semi")


def hourly_votes(posts: DataFrame, registry: DataFrame | None = None,
                 bounds: str = "half_open", first_hour: str | None = FIRST_HOUR) -> DataFrame:
    """Vote totals per query and hour, hours without posts left out.

    One pass over all hours, see :func:`counted_posts`. Totals are limited to
    registered queries when a hot query has shrunk to one row per hour.
    """
    totals = to_votes(sum_votes(counted_posts(posts, bounds, first_hour)))
    return of_registered(totals, registry)


def series(votes: DataFrame, topic: str | None = None) -> DataFrame:
    """Series rows ``(query, ts_ms, ups, total)``, of one topic or of all."""
    if topic is not None:
        votes = votes.filter(F.col("query") == topic)
    return votes.select("query", to_millis("time_utc").alias("ts_ms"),
                        F.col("ups").cast("bigint").alias("ups"),
                        (F.col("ups") + F.col("downs")).cast("bigint").alias("total"))


def topic_series(votes: DataFrame, topic: str) -> DataFrame:
    """One topic's series, oldest first."""
    return series(votes, topic).orderBy("ts_ms")


def series_arrays(rows: DataFrame, topics: DataFrame, value: str = "ups") -> DataFrame:
    """Each topic with its series as an ordered array of ``(ts_ms, y)``.

    Topics without data keep an empty array. An array holds one entry per hour,
    so it is bounded by the hours on record, not by the number of posts.
    """
    point = F.struct("ts_ms", F.col(value).alias("y"))
    arrays = rows.groupBy("query").agg(F.sort_array(F.collect_list(point)).alias("data"))
    empty = F.array().cast("array<struct<ts_ms:bigint,y:bigint>>")
    return (topics.select("query").distinct()
            .join(arrays, "query", "left")
            .select("query", F.coalesce("data", empty).alias("data")))


def visible(rows: DataFrame, span: str = "1 year") -> DataFrame:
    """The last ``span`` of each topic's series, both ends included."""
    newest = F.max("ts_ms").over(Window.partitionBy("query"))
    start = F.unix_millis(F.timestamp_millis("_newest") - F.expr(f"INTERVAL {span}"))
    return (rows.withColumn("_newest", newest)
            .filter(F.col("ts_ms") >= start).drop("_newest"))


def series_percent(rows: DataFrame, value: str = "ups", span: str | None = "1 year") -> DataFrame:
    """Change of each point against the topic's first non-zero visible value.

    The windows run over hourly totals, so a topic's group is bounded by hours.
    """
    if span is not None:
        rows = visible(rows, span)
    y = F.col(value)
    by_time = (Window.partitionBy("query").orderBy("ts_ms")
               .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    base = F.first(F.when(y != 0, y), ignorenulls=True).over(by_time)
    return (rows.withColumn("_base", base)
            .withColumn("pct", percent_change(y, "_base"))
            .select("query", "ts_ms", "pct", percent_label("pct").alias("label")))


def count_at(posts: DataFrame, cursor: DataFrame, seconds: int = TRAILING_SECONDS,
             limit: int = BROADCAST_BYTES) -> DataFrame:
    """Posts per topic in the ``seconds`` that end at the topic's cursor.

    One aggregate over the cursors gives their size and the times they span,
    which the scan of the posts is limited to. With cursors small enough to
    broadcast only counts are shuffled.
    """
    known = cursor.filter(F.col("lasttime").isNotNull()).select("query", "lasttime")
    size, oldest, newest = span_of(known)
    at, end = F.unix_seconds("created_utc"), F.unix_seconds("lasttime")
    rows = posts.select("query", "created_utc", "doc_id").filter(
        (F.col("created_utc") >= F.timestamp_seconds(F.lit((oldest or 0) - seconds)))
        & (F.col("created_utc") < F.timestamp_seconds(F.lit((newest or 0) + 1))))
    near = (lookup_join(rows, known, ["query"], "inner", ["doc_id"], limit, size)
            .filter(at.between(end - seconds, end)))
    return near.groupBy("query", "lasttime").agg(F.count("*").alias("n"))


def span_of(known: DataFrame) -> tuple[int, int | None, int | None]:
    """Size of cursors, and the first and last second among them."""
    at = F.unix_seconds("lasttime")
    found = known.agg(F.sum(row_bytes(known)), F.min(at), F.max(at)).first()
    return found[0] or 0, found[1], found[2]


def trailing_counts(posts: DataFrame, seconds: int = TRAILING_SECONDS) -> DataFrame:
    """Posts per topic in the ``seconds`` up to each second it has a post in.

    Seconds are counted first and then summed over time slices of
    ``SLICE_SPANS`` look-backs, each slice also getting the last look-back of its
    predecessor: only these rows are there twice. A window group is at most a
    slice and a look-back of seconds, whatever the number of posts.
    """
    placed = _in_slices(_per_second(posts), seconds)
    back = (Window.partitionBy("query", "_slice").orderBy("sec")
            .rangeBetween(-seconds, Window.currentRow))
    return (placed.withColumn("n", F.sum("n").over(back))
            .filter(F.col("_slice") == _slice_of("sec", seconds))
            .select("query", F.timestamp_seconds("sec").alias("until_utc"), "n"))


def _slice_of(sec: str, seconds: int, ahead: int = 0) -> Column:
    return F.floor((F.col(sec) + ahead) / (SLICE_SPANS * seconds))


def _in_slices(per_second: DataFrame, seconds: int) -> DataFrame:
    """Seconds in every ``_slice`` that looks back on them: their own, or the next, too."""
    return per_second.withColumn("_slice", F.explode(F.array_distinct(F.array(
        _slice_of("sec", seconds), _slice_of("sec", seconds, ahead=seconds)))))


def _per_second(posts: DataFrame) -> DataFrame:
    return (posts.groupBy("query", F.unix_seconds("created_utc").alias("sec"))
            .agg(F.count("*").alias("n")))


def sliding_counts(posts: DataFrame, length: str = "5 minutes", every: str = "1 minute") -> DataFrame:
    """Posts per topic and sliding window; ``posts`` may be a stream."""
    return (posts.groupBy("query", F.window("created_utc", length, every).alias("w"))
            .agg(F.count("*").alias("n"))
            .select("query", F.col("w.end").alias("until_utc"), "n"))


def paned_counts(posts: DataFrame, length: str = "5 minutes", every: str = "1 minute") -> DataFrame:
    """The rows of :func:`sliding_counts`, by way of panes; ``posts`` may be a stream.

    Posts are counted once into panes as long as the slide, and a pane counts in
    each window over it. A post is one row of one pane however many windows
    overlap; only panes are copied. ``length`` is a whole number of slides.
    """
    panes = (posts.groupBy("query", F.window("created_utc", every).alias("pane"))
             .agg(F.count("*").alias("n")))
    return (panes.groupBy("query", F.window(F.window_time("pane"), length, every).alias("w"))
            .agg(F.sum("n").alias("n"))
            .select("query", F.col("w.end").alias("until_utc"), "n"))


# Grains of a series: hours, and what they add up to.
GRAINS = ("hour", "day", "month")
# Spans up to these are drawn by the hour, by the day; longer ones by the month.
HOURLY_SPAN, DAILY_SPAN = "14 days", "366 days"


def grain_totals(votes: DataFrame) -> DataFrame:
    """Totals per query by hour, day and month in one pass, told apart by ``grain``.

    Grouping sets expand stored totals (a row per query and hour), not posts; sums
    of each grain are taken before the shuffle.
    """
    stamped = votes.select("query", *[F.date_trunc(g, "time_utc").alias(g) for g in GRAINS],
                           "ups", "downs")
    which = F.grouping_id().alias("_set")
    sets = [("query", g) for g in GRAINS]
    # grouping_id has a bit per column, first to last, set for those summed over.
    ids = {sum(1 << (len(GRAINS) - 1 - i) for i, other in enumerate(GRAINS) if other != g): g
           for g in GRAINS}
    made = (stamped.groupingSets(sets, "query", *GRAINS)
            .agg(which, F.sum("ups").alias("ups"), F.sum("downs").alias("downs")))
    grain = F.coalesce(*[F.when(F.col("_set") == i, F.lit(g)) for i, g in ids.items()])
    return made.select("query", grain.alias("grain"), F.coalesce(*GRAINS).alias("time_utc"),
                       "ups", "downs")


def drawn_series(totals: DataFrame, span: str) -> DataFrame:
    """The visible ``span`` of every topic's series, at the grain that the span calls for.

    ``totals`` are those of :func:`grain_totals`. The span reaches back from each
    topic's newest point of that grain, both ends included.
    """
    days = F.expr(f"timestamp'2000-01-01' + interval {span}")
    limit = lambda s: F.expr(f"timestamp'2000-01-01' + interval {s}")
    grain = (F.when(days <= limit(HOURLY_SPAN), "hour").when(days <= limit(DAILY_SPAN), "day")
             .otherwise("month"))
    rows = totals.filter(F.col("grain") == grain)
    return visible(series(rows), span)


def distinct_instants(posts: DataFrame) -> DataFrame:
    """The x axis: every instant any post carries, once."""
    return posts.select("created_utc").distinct()
