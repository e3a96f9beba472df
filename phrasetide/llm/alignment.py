"""Alignment of two tokenisations of every text.

Equal texts are brought together first, so each distinct text is tokenised and
aligned once; the pairs of tokens it links count as often as the text occurs.
Measures go back to the documents by the digest of their texts.

Both vocabularies are byte-pair encodings, in which what no token holds is never
merged: texts are encoded in fragments, most of which a worker has seen before.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phrasetide.llm.bpe import Codec, Memory, packed
from phrasetide.llm.common import small_batches, written
from phrasetide.operators.lookup import salted

# Pair counts are sent to all tasks only up to this size, 20 bytes a pair.
PAIR_BYTES = 32 * 1024 * 1024
# Pairs that a counting task holds before it passes them on.
HELD_PAIRS = 2_000_000


class ByteSide:
    """A byte-level vocabulary of the tokenizers library; a space goes before the text."""

    def __init__(self, path: str):
        self.codec = Codec(path)
        # The strings of special tokens are ordinary text.
        self.codec.library.encode_special_tokens = True
        self.codec.special = re.compile(r"(?!)")
        self.token_bytes = self.codec.token_bytes

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.codec.encode(" " + text), "<u4")


class PieceSide:
    """A sentencepiece vocabulary that adds a space before the text itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.token_bytes = [self._bytes(p) for p in pieces]
        # No piece has a space behind another sign, so a text may be cut there.
        if any(" " in t.decode(errors="replace").lstrip(" ") for t in self.token_bytes):
            raise ValueError("a piece goes on after a space")
        self.space = packed([self.library.piece_to_id("▁")])
        self.memory = Memory(self._encode_part)

    @staticmethod
    def _bytes(piece: str) -> bytes:
        if re.fullmatch("<0x[0-9A-F]{2}>", piece):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def _encode_part(self, part: str) -> bytes:
        # The library adds a space to what it is given, but nothing to nothing.
        return packed(self.library.encode(part[1:], num_threads=1)) if part != " " else self.space

    def encode(self, text: str) -> np.ndarray:
        if "▁" in text:  # the library takes it for a space
            return np.array(self.library.encode(text, num_threads=1), "<u4")
        # Every fragment is a run of spaces and what follows up to the next one.
        parts = re.findall(" +[^ ]*", " " + text)
        return np.frombuffer(b"".join(map(self.memory.__getitem__, parts)), "<u4")


class Aligner:
    """Token groups and links of single texts under both vocabularies."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteSide(path_a), PieceSide(path_b)
        self.sizes_a, self.sizes_b = (np.array([len(t) for t in side.token_bytes], np.int64)
                                      for side in (self.a, self.b))
        most = max(len(self.sizes_a), len(self.sizes_b))
        # Every id as text with what may follow it.
        self.named = np.array([[f"{i}{sign}" for i in range(most)] for sign in ",|;"], object)

    def align(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of both sides, and the places in each that end a group with the other.

        None for the empty text and where either side's bytes aren't the text's.
        """
        if not text:
            return None
        a, b = self.a.encode(text), self.b.encode(text)
        wanted = b" " + text.encode()
        for ids, side in ((a, self.a), (b, self.b)):
            if b"".join(map(side.token_bytes.__getitem__, ids.tolist())) != wanted:
                return None
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        at = np.zeros(len(wanted) + 1, bool)
        at[ends_a] = True
        in_b = np.flatnonzero(at[ends_b])
        at[ends_a] = False
        at[ends_b] = True
        return a, b, np.flatnonzero(at[ends_a]), in_b

    def groups(self, a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray) -> str:
        """The groups as ``a1,a2|b1;a3|b2,b3``: decimal ids in order."""
        signs_a, signs_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        signs_a[in_a], signs_b[in_b] = 1, 2
        # A token's group; those of a group in order, A before B.
        group_a = np.repeat(np.arange(len(in_a)), np.diff(in_a, prepend=-1))
        group_b = np.repeat(np.arange(len(in_b)), np.diff(in_b, prepend=-1))
        made = np.empty(len(a) + len(b), object)
        made[np.arange(len(a)) + np.append(0, in_b + 1)[group_a]] = self.named[signs_a, a]
        made[np.arange(len(b)) + (in_a + 1)[group_b]] = self.named[signs_b, b]
        return "".join(made.tolist())[:-1]


@cache
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


# Distinct links of a text are packed as sorted ids of pairs, then how often each
# occurs. The id of a pair of tokens a and b is b times WIDTH plus a.
WIDTH = 1 << 20
MEASURES = ("digest binary, copies long, n_a long, n_b long, n_groups long, pairs binary, "
            "times binary, groups string")


def _align_texts(path_a: str, path_b: str, digests: bool) -> Callable:
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.string())
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                found = aligner.align(text)
                if found is None:
                    rows.append((0, 0, 0, b"", b"", ""))
                    continue
                a, b, in_a, in_b = found
                groups = aligner.groups(*found)
                if digests:
                    groups = hashlib.sha256(groups.encode()).hexdigest()
                pairs, times = np.unique(b[in_b].astype(np.int64) * WIDTH + a[in_a],
                                         return_counts=True)
                rows.append((len(a), len(b), len(in_a), pairs.astype("<i8").tobytes(),
                             times.astype("<u4").tobytes(), groups))
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else \
                [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), batch.column("copies"), *columns],
                names=[f.split()[0] for f in MEASURES.split(", ")])
    return align


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs and times of all texts of a batch in a row, and how many each text has."""
    times = batch.column("times").to_pylist()
    return (np.frombuffer(b"".join(batch.column("pairs").to_pylist()), "<i8"),
            np.frombuffer(b"".join(times), "<u4").astype(np.int64),
            np.array([len(t) // 4 for t in times], np.int64))


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(pairs: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(sums)], names=["pair", "n"])

    pairs = sums = np.zeros(0, np.int64)
    for batch in batches:
        new, times, sizes = _flat(batch)
        times = times * np.repeat(batch.column("copies").to_numpy(), sizes)
        pairs, at = np.unique(np.concatenate([pairs, new]), return_inverse=True)
        total = np.zeros(len(pairs), np.int64)
        np.add.at(total, at, np.concatenate([sums, times]))
        sums = total
        if len(pairs) > HELD_PAIRS:
            yield rows(pairs, sums)
            pairs = sums = np.zeros(0, np.int64)
    yield rows(pairs, sums)


def pair_counts(measures: DataFrame) -> DataFrame:
    """How many links of the whole corpus each ``pair`` has (``n``), and whether it is ``best``:
    none of the pairs with its token of the second vocabulary has more.

    The pairs of one such token are as many as the first vocabulary has tokens at most.
    """
    counted = (measures.select("copies", "pairs", "times")
               .mapInArrow(_count_pairs, "pair long, n long")
               .groupBy("pair").agg(F.sum("n").alias("n")))
    of_token = Window.partitionBy(F.expr(f"pair div {WIDTH}"))
    return counted.withColumn("best", F.col("n") == F.max("n").over(of_token))


SCORED = ("digest binary, n_a long, n_b long, n_groups long, n_links long, n_best long, "
          "count_sum long, groups string")


def _score(table) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, best = table.value
        for batch in batches:
            pairs, times, sizes = _flat(batch)
            at = np.searchsorted(known, pairs)
            ends = np.cumsum(sizes)
            n_links, n_best, count_sum = (
                pa.array(sums[ends] - sums[ends - sizes]) for sums in (
                    np.append(0, np.cumsum(column)) for column in
                    (times, times * best[at], times * counts[at])))
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, ("digest", "n_a", "n_b", "n_groups")), n_links, n_best,
                 count_sum, batch.column("groups")],
                names=[f.split()[0] for f in SCORED.split(", ")])
    return score


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs, times, sizes = _flat(batch)
        rows = pa.array(np.repeat(np.arange(batch.num_rows), sizes))
        yield pa.RecordBatch.from_arrays(
            [batch.column("digest").take(rows), pa.array(pairs), pa.array(times)],
            names=["digest", "pair", "times"])


def _scored(measures: DataFrame, counts: DataFrame, limit: int) -> DataFrame:
    """``measures`` with what the counts of their pairs say.

    Up to ``limit`` bytes the counts are sent to all tasks, and the texts stay
    where they are. Beyond it a row per text and distinct pair meets the counts;
    a pair that most texts have is spread over salts.
    """
    spark = measures.sparkSession
    if counts.count() * 20 <= limit:
        table = counts.toArrow().sort_by("pair")
        arrays = tuple(table.column(c).to_numpy() for c in ("pair", "n", "best"))
        return measures.mapInArrow(_score(spark.sparkContext.broadcast(arrays)), SCORED)
    big, small = salted(
        measures.select("digest", "pairs", "times")
        .mapInArrow(_explode, "digest binary, pair long, times long"), counts, ["digest"])
    sums = (big.join(small, ["pair", "_salt"]).groupBy("digest").agg(
        F.sum("times").alias("n_links"),
        F.sum(F.col("times") * F.col("best").cast("int")).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum")))
    zero = F.lit(0).cast("bigint")
    return measures.join(sums, "digest", "left").select("digest", "n_a", "n_b", "n_groups", *(
        F.coalesce(c, zero).alias(c) for c in ("n_links", "n_best", "count_sum")), "groups")


def aligned(docs: DataFrame, path_a: str, path_b: str, *, digests: bool = True,
            limit: int = PAIR_BYTES) -> DataFrame:
    """Alignment of every whole text under a byte-level and a sentencepiece vocabulary.

    ``path_a`` and ``path_b`` name the files on every executor. Both sides encode
    the text behind one space, special tokens' strings as plain text. Where tokens
    of both end at one byte a group ends, and its last tokens are linked. Returns
    ``doc_id``, tokens ``n_a`` and ``n_b``, ``n_groups``, ``n_links``, ``n_best``
    (links whose pair is, over all documents, the most frequent of its second
    token, ties included), ``count_sum`` (over links, the count of their pair) and
    ``groups``: ``a1,a2|b1;a3|b2,b3`` as text, or with ``digests`` (the default)
    its SHA-256 as ``groups_sha256``.

    Null and empty texts, and those whose tokens' bytes aren't the text's on
    either side, have zeros and an empty ``groups``, and no links. Only ``doc_id``
    and ``text`` are read; repeated rows count as often as they occur and give
    repeated results; a null ``doc_id`` is carried along. An empty table gives an
    empty result. The stored measures of distinct texts and the pair counts are
    written, so a lost executor doesn't bring the tokenisers back.
    """
    texts = small_batches(docs).select("doc_id", "text")
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    distinct = (texts.filter("text != ''").groupBy("text").agg(F.count("*").alias("copies"))
                .select(digest, "text", "copies"))
    measures = written(distinct.mapInArrow(_align_texts(path_a, path_b, digests), MEASURES),
                       "alignments")
    counts = written(pair_counts(measures), "pair-counts")
    # Written, so that the join is of two plain shuffles, whose hot keys adaptive
    # execution splits.
    scored = written(_scored(measures, counts, limit), "aligned")
    zero = F.lit(0).cast("bigint")
    return (texts.select("doc_id", digest).join(scored, "digest", "left").select("doc_id", *(
        F.coalesce(c, zero).alias(c)
        for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
        F.coalesce("groups", F.lit("")).alias("groups_sha256" if digests else "groups")))
