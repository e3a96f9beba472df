"""Inverse search: which registered phrase queries does each post match?

Written as an equi-join. Every phrase is filed under one run of at most
``MAX_GRAM`` tokens, every post offers its distinct runs of those lengths, and
the two meet in a hash join. Phrases up to ``MAX_GRAM`` tokens are matched by
that alone; longer ones are filed under the run that fewest phrases share and
then looked for in the whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from phrasetide.functions.text import contains_phrase, grams, phrase, tokens
from phrasetide.operators import lookup
from phrasetide.session import new_work_dir

MAX_GRAM = 3
TOP_MATCHES = 5

# A gram in more posts than this isn't shuffled to one task with them.
HEAVY_POSTS = 1_000_000

# Grams that the sketch of offers tracks, and the most it is asked for. It counts
# any gram too low by at most four thirds of the offers, divided by those tracked.
TRACKED_GRAMS, MOST_HEAVY = 10_000, 1_000

# Bits of a bitmap per registered gram: one unknown gram in nine passes it.
GRAM_BITS = 8


@dataclass(frozen=True)
class PhraseIndex:
    """Registered phrases with the run of tokens each is filed under.

    ``rows`` has ``gram``, ``phrase``, ``words`` and the caller's payload.
    """

    rows: DataFrame
    lengths: tuple[int, ...]
    has_long: bool
    size: int


def phrases(registry: DataFrame) -> DataFrame:
    """Distinct queries as ``(query, phrase)``; those without a token match nothing."""
    return (registry.select("query").distinct()
            .withColumn("phrase", phrase("query"))
            .filter(F.length("phrase") > 0))


def index_phrases(rows: DataFrame, limit: int = lookup.BROADCAST_BYTES) -> PhraseIndex:
    """File phrases (column ``phrase`` plus payload) under their grams.

    Runs one aggregate over the registry to learn its gram lengths and size.
    """
    rows = rows.withColumn("words", F.size(F.split("phrase", " ")))
    found = rows.agg(
        F.collect_set(F.least("words", F.lit(MAX_GRAM))).alias("lengths"),
        F.max("words").alias("longest"),
        F.sum(lookup.row_bytes(rows) + F.octet_length("phrase")).alias("size"),
        # Bound for the distinct grams of all phrases with their counts.
        F.sum(MAX_GRAM * F.octet_length("phrase") + 80 * F.col("words")).alias("grams"),
    ).first()
    has_long = (found.longest or 0) > MAX_GRAM
    if has_long:
        # Short phrases are their own gram and find no entry to replace it.
        filed = rows.join(_filed_under(rows, found.grams, limit), "phrase", "left")
        rows = filed.withColumn("gram", F.coalesce("gram", "phrase"))
    else:
        rows = rows.withColumn("gram", F.col("phrase"))
    return PhraseIndex(rows, tuple(sorted(found.lengths)), has_long, found.size or 0)


def _filed_under(rows: DataFrame, gram_bytes: int, limit: int) -> DataFrame:
    """Long phrases with the ``gram`` that fewest of them share.

    An opening like "how to make" may be common to a third of all phrases;
    filing them there would hand every post with those words all of them.
    """
    texts = rows.filter(F.col("words") > MAX_GRAM).select("phrase").distinct()
    offered = (texts.withColumn("_tokens", F.split("phrase", " "))
               .withColumn("_grams", F.array_distinct(grams("_tokens", MAX_GRAM)))
               .select("phrase", F.explode_outer("_grams").alias("gram"))
               .filter(F.col("gram").isNotNull()))
    # Phrases per gram, counted before the join so that shared grams shrink first.
    shared = offered.groupBy("gram").agg(F.count("*").alias("n"))
    return (lookup.lookup_join(offered, shared, ["gram"], "inner", ["phrase"],
                               limit, gram_bytes)
            .groupBy("phrase").agg(F.min(F.struct("n", "gram")).alias("best"))
            .select("phrase", F.col("best.gram").alias("gram")))


def _offer(posts: DataFrame, text: str, index: PhraseIndex) -> DataFrame:
    """Posts with one row per distinct gram of the lengths the index uses.

    The gram array is a column of its own before it is exploded: the explode
    then stays in one generated stage with the join, and a post's text is not
    copied for each of its grams. ``explode_outer`` because for a plain explode
    Spark adds a filter on the array's size, pushes it below the projections
    and there tokenises the text again for every token. The NULL it yields for
    a text without tokens meets no phrase.
    """
    rows = posts.withColumn("_tokens", tokens(text))
    if index.has_long:
        rows = rows.withColumn("_text", F.array_join("_tokens", " "))
    runs = F.concat(*[grams("_tokens", n) for n in index.lengths])
    return (rows.withColumn("_grams", F.array_distinct(runs))
            .drop("_tokens")
            .withColumn("gram", F.explode_outer("_grams"))
            .drop("_grams"))


def _known_grams(offered: DataFrame, index: PhraseIndex,
                 limit: int | None = None) -> DataFrame:
    """The offered grams that some phrase may be filed under.

    The registered grams' hashes are broadcast, and other grams don't enter the
    shuffle. Hashes beyond ``limit`` bytes (by default the broadcast limit)
    become a bitmap of ``GRAM_BITS`` bits for each, in blocks of Spark's bitmap
    functions; an unknown gram that passes it finds no phrase later. A bitmap
    beyond the limit would belong to a registry of several hundred million grams.
    """
    limit = lookup.BROADCAST_BYTES if limit is None else limit
    hashes = index.rows.select(F.xxhash64("gram").alias("_hash")).distinct()
    found = hashes.agg(F.sum(lookup.row_bytes(hashes)), F.count("*")).first()
    offered = offered.withColumn("_hash", F.xxhash64("gram"))
    if (found[0] or 0) <= limit:
        return offered.join(F.broadcast(hashes), "_hash", "left_semi").drop("_hash")
    bits = 1 << max(15, (GRAM_BITS * found[1]).bit_length())
    if bits // 8 > limit:
        return offered.drop("_hash")
    place = F.pmod("_hash", F.lit(bits))
    blocks = (hashes.groupBy(F.bitmap_bucket_number(place).alias("_block"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits")))
    byte = F.conv(F.hex(F.substring("_bits", (F.col("_at") / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return (offered.withColumns({"_block": F.bitmap_bucket_number(place),
                                 "_at": F.bitmap_bit_position(place)})
            .join(F.broadcast(blocks), "_block")
            .filter(F.getbit(byte.cast("int"), F.pmod("_at", F.lit(8)).cast("int")) == 1)
            .drop("_hash", "_block", "_at", "_bits"))


def _offers(offered: DataFrame) -> tuple[DataFrame, list[str]]:
    """The offers, written, and the grams that more than ``HEAVY_POSTS`` posts make.

    Posts are tokenised once: a sketch of the most frequent grams is filled on
    the way to the disk, and partial sketches are all that is merged. Their few
    index rows are brought to the posts, not the posts to one task each. A gram
    that the sketch misses costs time, not rows.
    """
    path = new_work_dir(offered.sparkSession, "offers")
    seen = Observation()
    top = F.expr(f"approx_top_k(gram, {MOST_HEAVY}, {TRACKED_GRAMS})")
    offered.observe(seen, top.alias("top")).write.parquet(path)
    heavy = [r["item"] for r in seen.get["top"] or () if r["count"] > HEAVY_POSTS]
    return offered.sparkSession.read.schema(offered.schema).parquet(path), heavy


def match(posts: DataFrame, index: PhraseIndex, text: str = "title", key: str = "id",
          limit: int = lookup.BROADCAST_BYTES, keys_only: bool = False) -> DataFrame:
    """Posts joined with the index rows whose phrase they contain.

    Yields the post columns (``keys_only``: the key alone) and the index
    payload, one row per post and matching index row. ``key`` must be unique;
    posts without one are left out, as they could not be stored. An index whose
    measured size is within ``limit`` is broadcast, and posts are matched where
    they lie. A larger one is shuffled: only keys and those grams travel that
    some phrase is filed under, but for the grams in very many posts, whose few
    index rows come to the posts. The pairs found are joined back to the posts.
    """
    payload = [c for c in index.rows.columns if c not in ("gram", "phrase", "words")]
    kept = [key] if keys_only else posts.columns
    posts = posts.filter(F.col(key).isNotNull())
    if not index.lengths:
        types = {f.name: f.dataType for f in index.rows.schema}
        return posts.filter(F.lit(False)).select(
            *kept, *[F.lit(None).cast(types[c]).alias(c) for c in payload])
    if index.size <= limit:
        found = _offer(posts, text, index).join(F.broadcast(index.rows), "gram")
        if index.has_long:
            found = found.filter((F.col("words") <= MAX_GRAM)
                                 | contains_phrase("_text", "phrase"))
        return found.select(*kept, *payload)
    offered, heavy = _offers(_known_grams(
        _offer(posts.select(key, text), text, index).select(key, "gram"), index))
    pairs = offered.join(index.rows, "gram")
    if heavy:
        is_heavy = F.col("gram").isin(heavy)
        pairs = offered.filter(~is_heavy).join(index.rows, "gram").unionByName(
            lookup.lookup_join(offered.filter(is_heavy), index.rows.filter(is_heavy), ["gram"],
                               "inner", [key]))
    pairs = pairs.select(key, "phrase", "words", *payload)
    if keys_only and not index.has_long:
        return pairs.select(*kept, *payload)
    if index.has_long:
        # Reduced once per post here, not once per pair after the join.
        posts = posts.withColumn("_text", phrase(text))
    found = posts.join(pairs, key)
    if index.has_long:
        found = found.filter((F.col("words") <= MAX_GRAM) | contains_phrase("_text", "phrase"))
    return found.select(*kept, *payload)


def percolate(posts: DataFrame, registry: DataFrame, text: str = "title",
              key: str = "id", limit: int = lookup.BROADCAST_BYTES) -> DataFrame:
    """Posts with a ``query`` column, one row per post and matching query."""
    return match(posts, index_phrases(phrases(registry), limit), text, key, limit)


def matched_ids(posts: DataFrame, registry: DataFrame, text: str = "title",
                key: str = "id", limit: int = lookup.BROADCAST_BYTES) -> DataFrame:
    """Ids of the posts that match any query."""
    distinct = phrases(registry).select("phrase").distinct()
    found = match(posts, index_phrases(distinct, limit), text, key, limit, keys_only=True)
    return found.select(key).distinct()


def match_counts(posts: DataFrame, registry: DataFrame, text: str = "title", key: str = "id",
                 cap: int = TOP_MATCHES, limit: int = lookup.BROADCAST_BYTES) -> DataFrame:
    """Per matching post the number of queries it matches, whole and clipped."""
    per_phrase = phrases(registry).groupBy("phrase").agg(F.count("*").alias("_queries"))
    found = match(posts, index_phrases(per_phrase, limit), text, key, limit, keys_only=True)
    return (found.groupBy(key).agg(F.sum("_queries").alias("match_total"))
            .withColumn("capped", F.least("match_total", F.lit(cap).cast("bigint"))))


def percolate_top(posts: DataFrame, registry: DataFrame, n: int = TOP_MATCHES,
                  text: str = "title", key: str = "id",
                  limit: int = lookup.BROADCAST_BYTES) -> DataFrame:
    """Posts with ``query`` and ``rank``: the first ``n`` queries by name.

    Queries that share a phrase match the same posts, so only ``n`` of them can
    be among any post's first ``n``; the others need not take part. Ranking
    handles pairs of key and query only, and the posts are joined to the ``n``
    that remain: a long post with many matches is not copied for each of them.
    Posts that lie together by key (:func:`ingest.keep_one_per_id`) are ranked
    and joined without another shuffle.
    """
    by_name = Window.partitionBy("phrase").orderBy("query")
    candidates = (phrases(registry)
                  .withColumn("_nth", F.row_number().over(by_name))
                  .filter(F.col("_nth") <= n).drop("_nth"))
    index = index_phrases(candidates, limit)
    pairs = match(posts.select(key, text), index, text, key, limit, keys_only=True)
    by_query = Window.partitionBy(key).orderBy("query")
    top = (pairs.withColumn("rank", F.row_number().over(by_query))
           .filter(F.col("rank") <= n))
    return posts.join(top, key).select(*posts.columns, "query", "rank")


def nested_matches(posts: DataFrame, registry: DataFrame, n: int = TOP_MATCHES,
                   text: str = "title", key: str = "id") -> DataFrame:
    """The percolate response per post: ``(id, total, matches)``.

    ``matches`` holds the first ``n`` queries as structs with ``_id``, so each
    array is at most ``n`` long however many queries match, and ``total``, which
    is clipped likewise, is its length.
    """
    top = (percolate_top(posts.select(key, text), registry, n, text, key)
           .groupBy(key)
           .agg(F.sort_array(F.collect_list(F.struct(F.col("query").alias("_id"))))
                .alias("matches")))
    return top.select(key, F.size("matches").cast("bigint").alias("total"), "matches")


def expand_matches(nested: DataFrame, key: str = "id") -> DataFrame:
    """One row per post and match of the nested response."""
    return (nested.select(key, F.explode("matches").alias("m"))
            .select(key, F.col("m._id").alias("query")))


def hit_ids(hits: DataFrame, column: str = "matches") -> DataFrame:
    """The nested response with the ids alone in its array."""
    return hits.withColumn(column, F.transform(column, lambda hit: hit["_id"]))
