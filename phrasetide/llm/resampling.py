"""Importance resampling of documents towards a target corpus.

Every feature (run of words) falls into one of a fixed number of buckets. The
gain of a bucket says how much more common it is in the target than in the
corpus; a document's weight is the sum of the gains of its features, looked up
in one array. With a Gumbel draw added, the documents of highest score are a
sample without replacement in proportion to the exponential of their weights.

The score at which the sample ends is found by bisection: jobs that count the
persisted scores above some thresholds, then ids among the scores tied there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phrasetide.llm.bpe import Memory
from phrasetide.llm.common import partitions, small_batches, written

BUCKETS = 10_000
RUN = 1  # words in the longest feature
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10

# Thresholds that one job counts: so many levels of halving at once.
LEVELS = 4

# What is no part of a word, A-Z lower-cased, becomes a space.
_LETTERS = bytes(b if b >= 0x80 or chr(b).isalnum() else 32 for b in range(256)).lower()


def words_of(text: str) -> list[bytes]:
    """Runs of ASCII letters (lower-cased), digits and characters beyond ASCII."""
    return text.encode().translate(_LETTERS).split()


@cache
def _memory(buckets: int) -> Memory:
    return Memory(lambda feature: crc32(feature) % buckets)


def features(text: str, buckets: int, run: int) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every feature of a text."""
    words = words_of(text)
    memory = _memory(buckets)
    made = list(map(memory.__getitem__, words))
    for n in range(2, run + 1):
        made += [memory[b" ".join(words[i:i + n])] for i in range(len(words) - n + 1)]
    return len(words), np.array(made, "<u4")


def _featured(buckets: int, run: int) -> Callable:
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, packed = [], []
            for text in batch.column("text").to_pylist():
                n, made = features(text, buckets, run)
                sizes.append(n)
                packed.append(made.astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()),
                 pa.array(packed, pa.binary())], names=["doc_id", "n_words", "features"])
    return make


def featured(docs: DataFrame, buckets: int = BUCKETS, run: int = RUN) -> DataFrame:
    """``doc_id`` (if there is one), ``n_words`` and packed feature buckets of whole texts."""
    doc_id = F.col("doc_id") if "doc_id" in docs.columns else F.lit(None)
    texts = small_batches(docs).select(doc_id.cast("bigint").alias("doc_id"),
                                       F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(_featured(buckets, run), "doc_id long, n_words long, features binary")


def _buckets_of(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of all rows of a batch, and how many each row has."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")
    values = column.to_pylist()
    sizes = np.array([len(v) // kind.itemsize for v in values], np.int64)
    return np.frombuffer(b"".join(values), kind), sizes


def _counted(buckets: int) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            sums += np.bincount(_buckets_of(batch.column(0), buckets)[0], minlength=buckets)
        found = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(sums[found])],
                                         names=["bucket", "n"])
    return count


def bucket_counts(rows: DataFrame, buckets: int) -> np.ndarray:
    """Features of all rows by bucket; one number per bucket comes to the driver."""
    found = (rows.select("features").mapInArrow(_counted(buckets), "bucket long, n long")
             .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())
    sums = np.zeros(buckets, np.int64)
    sums[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return sums


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of every bucket's smoothed shares, rounded down."""
    s, t, b = corpus.astype(np.float64), target.astype(np.float64), float(len(corpus))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + b) / ((s + 1) * (t.sum() + b)))
                    ).astype(np.int64)


def _weighed(table: np.ndarray) -> Callable:
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, sizes = _buckets_of(batch.column("features"), len(table))
            sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(table[found])])
            ends = np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array(sizes),
                 pa.array(sums[ends] - sums[ends - sizes])],
                names=["doc_id", "n_words", "n_features", "weight"])
    return weigh


def gumbel(seed: int) -> Column:
    """Thousandths of a Gumbel draw that ``seed`` and ``doc_id`` decide, rounded down."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _largest(rows: DataFrame, column: str, low: int, high: int, enough: Callable[[int], bool],
             counted: Callable[[int], Column]) -> int:
    """The largest value from ``low`` to ``high`` whose exact count is ``enough``.

    ``low`` is known to be and all values above ``high`` not to be. Every job
    counts the rows at the values that ``LEVELS`` halvings could ask for.
    """
    while low < high:
        step = -(-(high - low) // (1 << LEVELS))
        at = [*range(low + step, high, step), high]
        counts = rows.agg(*[F.coalesce(F.sum(counted(v).cast("bigint")), F.lit(0)) for v in at]).first()
        for value, n in zip(at, counts):
            if not enough(n):
                high = value - 1
                break
            low = value
    return low


def cutoff(scores: DataFrame, draw: int) -> tuple[int, int | None]:
    """Score and id of the last of the ``draw`` first rows, by score and smaller id.

    ``scores`` (``doc_id``, ``score``) has ``draw`` rows at least and is cheap to
    read. An id of None means that all rows of that score are in.
    """
    low, high = scores.agg(F.min("score"), F.max("score")).first()
    score = _largest(scores, "score", low, high, lambda n: n >= draw,
                     lambda v: F.col("score") >= v)
    tied = scores.filter(F.col("score") == score)
    above = scores.filter(F.col("score") > score).count()
    low, high, ids = tied.agg(F.min("doc_id"), F.max("doc_id"), F.count("doc_id")).first()
    if ids < draw - above:
        return score, None
    # The largest id before which there are too few is one before the wanted one.
    before = _largest(tied, "doc_id", low - 1, high, lambda n: n < draw - above,
                      lambda v: F.col("doc_id") <= F.lit(v)) if low <= high else high
    return score, before + 1


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, 3... by falling score, then rising ``doc_id``.

    Rows are range-partitioned by both, so a tied score isn't one task's; each
    partition numbers its rows and starts after the partitions before it.
    """
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"),
             F.col("weight")]
    placed = written(
        rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()
    before, done = F.lit(0).cast("bigint"), 0
    starts = {}
    for row in sorted(sizes):
        starts[row.part] = done
        done += row.n
    if starts:  # a number per partition
        before = F.get(F.split(F.lit(",".join(
            str(starts.get(p, 0)) for p in range(max(starts) + 1))), ",").cast("array<bigint>"), part)
    return placed.select(
        *rows.columns, (before + F.col("place").bitwiseAND((1 << 33) - 1) + 1).alias("rank"))


def resampled(docs: DataFrame, target: DataFrame, *, buckets: int = BUCKETS, run: int = RUN,
              seed: int = SEED, least_words: int = LEAST_WORDS,
              percent: int = PERCENT) -> DataFrame:
    """Every document's weight and score, and its rank if it is drawn.

    Of the documents with ``least_words`` words or more, ``percent`` of a hundred
    (rounded down) are drawn: those of highest score, ties to the smaller
    ``doc_id``. Returns ``doc_id``, ``n_words``, ``n_features``, ``weight``,
    ``score`` and ``rank`` (from 1; null if not drawn).

    Only ``doc_id`` and ``text`` of ``docs`` and ``text`` of ``target`` are read.
    A null text has no features and weight 0. A null ``doc_id`` draws as the
    empty one and comes last among ties; of repeated rows tied at the end as many
    are drawn as fit. Empty tables are allowed: without documents the result is
    empty, without target texts the gains are those of an empty target.

    Features are made once and persisted, two bytes each. Bucket counts and the
    array of gains have one number per bucket, whatever the data's size.
    """
    made = written(featured(docs, buckets, run), "features")
    corpus = bucket_counts(made, buckets)
    wanted = bucket_counts(featured(target, buckets, run), buckets)
    weighed = made.mapInArrow(
        _weighed(gains(corpus, wanted)),
        "doc_id long, n_words long, n_features long, weight long")
    scores = written(weighed.withColumn("score", F.col("weight") + gumbel(seed)), "scores")
    apt = scores.filter(F.col("n_words") >= least_words)
    draw = percent * apt.count() // 100
    none = F.lit(None).cast("bigint")
    if not draw:
        return scores.withColumn("rank", none)
    score, last_id = cutoff(apt, draw)
    at_end = F.lit(True) if last_id is None else F.col("doc_id") <= F.lit(last_id)
    drawn = F.coalesce((F.col("n_words") >= least_words) & (
        (F.col("score") > score) | ((F.col("score") == score) & at_end)), F.lit(False))
    firsts = ranked(scores.filter(drawn)).withColumn(
        "rank", F.when(F.col("rank") <= draw, F.col("rank")))
    return firsts.unionByName(scores.filter(~drawn).withColumn("rank", none))
