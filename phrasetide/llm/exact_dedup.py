"""Exact duplicates by counting quotient filters.

Every partition of fingerprints is turned into counting quotient filters, one
per slice of the fingerprint space. The filters of a slice are merged by their
sorted remainders, which loses nothing, so the merged filter counts every
fingerprint exactly. Only texts whose fingerprint counts more than one are
compared byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phrasetide.llm.common import SMALL_BYTES, SPACE_BYTES, SPACE_CLASS, texts_of, without, written

# Fingerprints a merged slice should hold on average.
SLICE_ROWS = 1_000_000


class QuotientFilter:
    """Sorted fingerprints with counts, stored as quotients and remainders.

    Of a 64-bit fingerprint the upper ``bits`` are the quotient, whose presence
    is one bit of ``occupied``; the rest is its remainder. The remainders of a
    quotient form a sorted run whose last one is marked in ``run_end``. Counts
    above one are kept apart, as most are one.
    """

    def __init__(self, bits: int, occupied: np.ndarray, run_end: np.ndarray,
                 remainders: np.ndarray, repeated: np.ndarray, counts: np.ndarray):
        self.bits, self.occupied, self.run_end = bits, occupied, run_end
        self.remainders, self.repeated, self.counts = remainders, repeated, counts

    @classmethod
    def of(cls, prints: np.ndarray, counts: np.ndarray) -> QuotientFilter:
        """The filter of sorted distinct ``prints`` (uint64)."""
        bits = max(1, min(32, int(len(prints)).bit_length()))
        shift = np.uint64(64 - bits)
        quotients = prints >> shift
        occupied = np.zeros(1 << bits, bool)
        occupied[quotients.astype(np.int64)] = True
        run_end = np.ones(len(prints), bool)
        run_end[:-1] = quotients[1:] != quotients[:-1]
        remainders = prints & ((np.uint64(1) << shift) - np.uint64(1))
        more = np.flatnonzero(counts > 1)
        return cls(bits, occupied, run_end, remainders, more.astype(np.int64), counts[more])

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """The sorted fingerprints and their counts."""
        runs = np.flatnonzero(self.occupied).astype(np.uint64)
        ends = np.flatnonzero(self.run_end)
        lengths = np.diff(ends, prepend=-1)
        prints = (np.repeat(runs, lengths) << np.uint64(64 - self.bits)) | self.remainders
        counts = np.ones(len(prints), np.int64)
        counts[self.repeated] = self.counts
        return prints, counts

    def to_bytes(self) -> bytes:
        head = np.array([self.bits, len(self.remainders), len(self.repeated)], "<i8")
        return b"".join([
            head.tobytes(), np.packbits(self.occupied).tobytes(),
            np.packbits(self.run_end).tobytes(), self.remainders.astype("<u8").tobytes(),
            self.repeated.astype("<i8").tobytes(), self.counts.astype("<i8").tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> QuotientFilter:
        bits, n, more = (int(x) for x in np.frombuffer(data, "<i8", 3))
        at, slots = 24, 1 << bits
        occupied = np.unpackbits(np.frombuffer(data, np.uint8, -(-slots // 8), at))[:slots]
        at += -(-slots // 8)
        run_end = np.unpackbits(np.frombuffer(data, np.uint8, -(-n // 8), at))[:n]
        at += -(-n // 8)
        remainders = np.frombuffer(data, "<u8", n, at)
        repeated = np.frombuffer(data, "<i8", more, at + 8 * n)
        counts = np.frombuffer(data, "<i8", more, at + 8 * n + 8 * more)
        return cls(bits, occupied.astype(bool), run_end.astype(bool), remainders, repeated, counts)

    def merged(self, other: QuotientFilter) -> QuotientFilter:
        """Both filters as one; equal fingerprints add their counts."""
        (a, m), (b, n) = self.entries(), other.entries()
        return QuotientFilter.of(*summed(np.concatenate([a, b]), np.concatenate([m, n])))


def summed(prints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints in order, with the sums of their counts."""
    order = np.argsort(prints, kind="stable")  # merges runs that are sorted already
    prints, counts = prints[order], counts[order]
    first = np.ones(len(prints), bool)
    first[1:] = prints[1:] != prints[:-1]
    at = np.flatnonzero(first)
    return prints[at], np.add.reduceat(counts, at) if len(at) else counts


class Runs:
    """What is sorted by itself, merged in pairs of like size.

    A run is merged with the one before it once it is half as large, so with n
    runs every element is touched about log n times and the runs held are at
    most twice the result. ``touched`` counts the elements merged.
    """

    def __init__(self, size: Callable, merge: Callable):
        self.size, self.merge, self.runs, self.touched = size, merge, [], 0

    def add(self, run) -> None:
        self.runs.append(run)
        while len(self.runs) > 1 and self.size(self.runs[-2]) <= 2 * self.size(self.runs[-1]):
            self._merge()

    def _merge(self) -> None:
        last, before = self.runs.pop(), self.runs.pop()
        self.touched += self.size(before) + self.size(last)
        self.runs.append(self.merge(before, last))

    def result(self):
        """All runs as one, or None if there was none."""
        while len(self.runs) > 1:
            self._merge()
        return self.runs[0] if self.runs else None


def normalised(text: bytes | None) -> bytes:
    return (text or b"").translate(None, SPACE_BYTES)


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.string())
        digests = [hashlib.sha256(normalised(t)).digest()
                   for t in texts.cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pc.utf8_length(texts).cast(pa.int64()),
             pa.array([int.from_bytes(d[:8], "big", signed=True) for d in digests], pa.int64()),
             pa.array([d.hex() for d in digests], pa.string())],
            names=["doc_id", "points", "print", "text_sha256"])


def hashed(docs: DataFrame) -> DataFrame:
    """Per row: code points, 64-bit fingerprint and SHA-256 of the normalised text."""
    return texts_of(docs).mapInArrow(
        _hash, "doc_id long, points long, print long, text_sha256 string")


def _filters(slice_bits: int):
    """Fingerprints of a partition to one filter per slice."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs(lambda run: len(run[0]),
                    lambda a, b: summed(*map(np.concatenate, zip(a, b))))
        for batch in batches:
            new = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            runs.add(summed(new, np.ones(len(new), np.int64)))
        prints, counts = runs.result() or (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        slices = (prints >> np.uint64(64 - slice_bits)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(slices, prepend=-1))
        for lo, hi in zip(cuts, [*cuts[1:], len(prints)]):
            part = QuotientFilter.of(prints[lo:hi], counts[lo:hi])
            yield pa.RecordBatch.from_arrays(
                [pa.array([slices[lo]], pa.int64()), pa.array([part.to_bytes()], pa.binary())],
                names=["slice", "filter"])
    return build


def _repeated(merged: QuotientFilter) -> pa.RecordBatch:
    prints, counts = merged.entries()
    more = counts > 1
    return pa.RecordBatch.from_arrays(
        [pa.array(prints[more].view(np.int64)), pa.array(counts[more])], names=["print", "n"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Filters in order of their slices to the fingerprints counted more than once."""
    at, runs = None, filter_runs()
    for batch in batches:
        for number, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            if number != at and at is not None:
                yield _repeated(runs.result())
                runs = filter_runs()
            at = number
            runs.add(QuotientFilter.from_bytes(data.as_buffer().to_pybytes()))
    if at is not None:
        yield _repeated(runs.result())


def filter_runs() -> Runs:
    return Runs(lambda part: len(part.remainders), QuotientFilter.merged)


def repeated_prints(prints: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``print`` and exact count ``n`` of every fingerprint seen more than once.

    ``prints`` has one long column and is cheap to count. The number of slices
    follows its rows, so a merging task holds about ``slice_rows`` fingerprints
    at any size; a fingerprint of a third of all rows is one entry per partition.
    """
    slice_bits = max(4, min(30, (prints.count() // slice_rows).bit_length()))
    parts = prints.mapInArrow(_filters(slice_bits), "slice long, filter binary")
    return (parts.repartition("slice").sortWithinPartitions("slice")
            .mapInArrow(_merge, "print long, n long"))


def _verified(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """Number of rows per digest, counted over the bytes of the normalised texts.

    Copies meet in the map-side aggregate, so each distinct text is shuffled
    once per task and a large group doesn't reach one task. Should one digest
    stand for two different texts, the job fails rather than joins them.
    """
    ids = candidates.select(F.col("doc_id").alias("id"))
    if candidates.count() * 16 <= SMALL_BYTES:
        ids = F.broadcast(ids)
    texts = texts_of(docs).join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    by_text = (texts.select(F.regexp_replace("text", SPACE_CLASS, "").alias("body"))
               .groupBy("body").agg(F.count("*").alias("n"))
               .withColumn("text_sha256", F.sha2("body", 256)))
    clash = F.raise_error(F.concat(F.lit("different texts of digest "), "text_sha256"))
    return (by_text.groupBy("text_sha256")
            .agg(F.count("*").alias("texts"), F.sum("n").alias("n"))
            .select("text_sha256", F.when(F.col("texts") > 1, clash.cast("bigint"))
                    .otherwise(F.col("n")).alias("group_size")))


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: which row of its group of equal texts stays.

    Texts are equal when identical without ASCII white space. The row with most
    code points stays, of those the one with the smallest ``doc_id``. A null
    text counts as empty, and all empty texts are one group. ``doc_id`` is taken
    as unique: rows that share the staying row's id and text stay together. Rows
    without id stay only if no row of their group has one and as many code
    points; ``keep_id`` is null then.
    Other columns aren't read. An empty table gives an empty result.
    """
    rows = written(hashed(docs), "hashed")
    repeated = written(repeated_prints(rows.select("print")), "repeated")
    candidates = written(rows.join(repeated.select("print"), "print"), "candidates")
    stays = (candidates.groupBy("text_sha256")
             .agg(F.max(F.struct("points", (-F.col("doc_id")).alias("minus_id"))).alias("best")))
    # Written, so that the join below is of two plain shuffles, whose hot keys
    # adaptive execution splits.
    groups = written(_verified(docs, candidates).join(stays, "text_sha256")
                     .select(F.col("text_sha256").alias("digest"), "group_size",
                             (-F.col("best.minus_id")).alias("best_id")), "groups")
    keep_id = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("best_id"))
    return (rows.join(groups, F.col("text_sha256") == F.col("digest"), "left")
            .select("doc_id", keep_id.alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
                    keep_id.eqNullSafe(F.col("doc_id")).alias("kept"),
                    "text_sha256"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``duplicate_groups`` drops."""
    groups = duplicate_groups(docs)
    return without(docs, groups.filter(~F.col("kept")).select("doc_id"))
