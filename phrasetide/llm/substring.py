"""Removal of passages that an earlier document has, by Rabin-Karp windows.

Every window of so many words is hashed by rolling over the document. Windows
are counted over the whole corpus; those that an earlier document has too are
repeated, and runs of repeated windows merge into maximal intervals of words.

Documents are dealt into batches by ranges of ``doc_id``, so of two batches all
documents of one are earlier. A window is therefore sent to be counted with its
batch only, once per batch however many documents there have it, and the answer
goes back to the batches after the first. Which of a batch's own documents is
the earliest is found in the batch.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phrasetide.llm.bpe import Memory
from phrasetide.llm.common import Buckets, texts_of

WINDOW = 13

# Bytes of text in a batch, and how many batches there are at most: at 100 TB a
# batch has 400 MB.
BATCH_BYTES = 8 * 1024 * 1024
MAX_BATCHES = 1 << 18

# Factors of the two rolling hashes, modulo 2^64; odd, so that they have inverses.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@cache
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of a base and of its inverse, modulo 2^64."""
    return tuple(np.cumprod(np.append(np.uint64(1), np.full(n - 1, factor, np.uint64)))
                 for factor in (base, pow(base, -1, 1 << 64)))


def rolling(values: np.ndarray, size: int, base: int) -> np.ndarray:
    """The Rabin-Karp hash of every window of ``size`` values (uint64).

    A window's hash is the sum of its values times powers of the base, modulo
    2^64: the running sum with the values before the window taken off, brought
    back to its first place. Equal windows have equal hashes anywhere.
    """
    windows = max(0, len(values) - size + 1)
    made = np.empty(windows, np.uint64)
    run = max(1 << 16, 2 * size)
    for at in range(0, windows, run):
        part = values[at:at + run + size - 1]
        up, down = _powers(base, run + size - 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[:len(part)], out=sums[1:])
        n = len(part) - size + 1
        made[at:at + n] = (sums[size:] - sums[:n]) * down[:n]
    return _mixed(made)


class Windows:
    """Words and window hashes of some texts; windows never cross texts.

    A window is known by 80 bits: ``keys`` (64) and ``checks`` (16), from two
    independent rolling hashes over 64-bit hashes of words.
    """

    def __init__(self, texts: list[str], size: int):
        self.words = [text.encode().split() for text in texts]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.starts = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(self.sizes, out=self.starts[1:])
        memory = _memory()
        values = np.empty(self.starts[-1], np.uint64)
        for at, words in zip(self.starts, self.words):
            values[at:at + len(words)] = np.fromiter(map(memory.__getitem__, words), np.uint64,
                                                     len(words))
        # Rolled over all texts at once; windows across two texts are left out.
        last = np.repeat(self.starts[1:] - size, self.sizes)
        self.places = np.flatnonzero(np.arange(len(values)) <= last)
        self.keys, self.checks = (rolling(v, size, base)[self.places]
                                  for v, base in zip((values, _mixed(values)), BASES))
        self.checks = (self.checks >> np.uint64(48)).astype(np.uint16)


@cache
def _memory() -> Memory:
    return Memory(xxhash.xxh3_64_intdigest)


def in_order(keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places that sort windows by both hashes, and where a new one starts there.

    Windows that are the same stay in their order.
    """
    order = np.argsort(keys, kind="stable")
    k, c = keys[order], checks[order]
    if ((k[1:] == k[:-1]) & (c[1:] != c[:-1])).any():
        order = np.lexsort((checks, keys))
        k, c = keys[order], checks[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    return order, new


def pack(keys: np.ndarray, checks: np.ndarray) -> bytes:
    """Sorted windows as the steps between keys, byte by byte, and their checks.

    High bytes of small steps are zeros in a row, which a shuffle compresses.
    """
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
    return steps.T.tobytes() + checks.astype("<u2").tobytes()


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // 10
    steps = np.frombuffer(data, np.uint8, 8 * n).reshape(8, n).T
    keys = np.cumsum(np.ascontiguousarray(steps).view("<u8").reshape(n), dtype=np.uint64)
    return keys, np.frombuffer(data, "<u2", n, 8 * n)


def _unpack_all(column: pa.ChunkedArray) -> list[tuple[np.ndarray, np.ndarray]]:
    return [unpack(data) for data in column.to_pylist()]


def _ranges(keys: np.ndarray, bits: int) -> np.ndarray:
    """The range of the hash space in which each key lies: its upper bits."""
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


PARTS = pa.schema([("range", pa.int64()), ("batch", pa.int64()), ("windows", pa.binary())])
MARKS = pa.schema([("batch", pa.int64()), ("windows", pa.binary())])


def _batch_windows(size: int, bits: int) -> Callable[[pa.Table], pa.Table]:
    """The distinct windows of a batch, one packed row per range of hashes."""
    def windows(table: pa.Table) -> pa.Table:
        made = Windows(table.column("text").to_pylist(), size)
        order, new = in_order(made.keys, made.checks)
        keys, checks = made.keys[order[new]], made.checks[order[new]]
        ranges = _ranges(keys, bits)
        cuts = np.flatnonzero(np.diff(ranges, prepend=-1))
        return pa.table([
            pa.array(ranges[cuts]),
            pa.array(np.full(len(cuts), table.column("batch")[0].as_py(), np.int64)),
            pa.array([pack(keys[i:j], checks[i:j]) for i, j in zip(cuts, [*cuts[1:], len(keys)])],
                     pa.binary())], schema=PARTS)
    return windows


def _count(table: pa.Table) -> pa.Table:
    """Of one range: for every batch the windows that an earlier batch has."""
    table = table.sort_by("batch")
    batches = table.column("batch").to_numpy()
    parts = _unpack_all(table.column("windows"))
    keys = np.concatenate([k for k, _ in parts])
    checks = np.concatenate([c for _, c in parts])
    part = np.repeat(np.arange(len(parts)), [len(k) for k, _ in parts])
    order, new = in_order(keys, checks)
    first = part[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    repeated = order[batches[part[order]] > batches[first]]
    keys, checks, part = keys[repeated], checks[repeated], part[repeated]
    by_part = np.argsort(part, kind="stable")  # keys stay in order within a part
    keys, checks, part = keys[by_part], checks[by_part], part[by_part]
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    return pa.table([
        pa.array(batches[part[cuts]]),
        pa.array([pack(keys[i:j], checks[i:j]) for i, j in zip(cuts, [*cuts[1:], len(keys)])],
                 pa.binary())], schema=MARKS)


def _known(keys: np.ndarray, checks: np.ndarray, marks: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which windows are among the sorted ``marks``."""
    found = np.zeros(len(keys), bool)
    if not len(marks[0]):
        return found
    at = np.searchsorted(marks[0], keys)
    open_ = np.flatnonzero(at < len(marks[0]))
    while len(open_):
        open_ = open_[marks[0][at[open_]] == keys[open_]]
        same = marks[1][at[open_]] == checks[open_]
        found[open_[same]] = True
        open_ = open_[~same]
        at[open_] += 1  # another window of the same key
        open_ = open_[at[open_] < len(marks[0])]
    return found


RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
    ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ("text", pa.string())])
RESULT_DDL = ("doc_id long, n_words long, n_removed long, "
              "removed array<struct<start: long, end: long>>, text string")


def _cut(size: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Documents of a batch without the words of repeated windows."""
    def cut(docs: pa.Table, marks: pa.Table) -> pa.Table:
        ids = docs.column("doc_id").to_pylist()
        made = Windows(docs.column("text").to_pylist(), size)
        place = {i: n for n, i in enumerate(sorted({i for i in ids if i is not None}))}
        rank = np.array([place.get(i, -1) for i in ids], np.int64)
        doc = np.repeat(rank, np.maximum(made.sizes - size + 1, 0))
        order, new = in_order(made.keys, made.checks)
        least = np.minimum.reduceat(doc[order], np.flatnonzero(new)) if len(order) else doc
        repeated = np.zeros(len(doc), bool)
        repeated[order] = doc[order] > least[np.cumsum(new) - 1] if len(order) else False
        parts = _unpack_all(marks.column("windows"))
        if parts:
            sent = [np.concatenate(c) for c in zip(*parts)]
            by_key = np.argsort(sent[0], kind="stable")
            repeated |= _known(made.keys, made.checks, (sent[0][by_key], sent[1][by_key]))
        starts = made.places[repeated]
        cover = np.zeros(made.starts[-1] + 1, np.int32)
        cover[starts] += 1
        cover[starts + size] -= 1
        gone = np.cumsum(cover[:-1]) > 0
        rows = []
        for i, words, at in zip(ids, made.words, made.starts):
            flags = gone[at:at + len(words)]
            n = int(flags.sum())
            edges = np.flatnonzero(np.diff(flags, prepend=False, append=False)).tolist() if n else []
            kept = compress(words, (~flags).tolist()) if n else words
            rows.append((i, len(words), n, [{"start": s, "end": e} for s, e in
                                            zip(edges[::2], edges[1::2])],
                         b" ".join(kept).decode()))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), RESULT)], schema=RESULT) \
            if rows else RESULT.empty_table()
    return cut


def without_repeats(docs: DataFrame, size: int = WINDOW,
                    batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Every document without the passages that a document of smaller ``doc_id`` has.

    A word goes if it is covered by a window of ``size`` words that also starts
    in a document with a smaller ``doc_id``; windows are those of the input.
    Returns ``doc_id``, ``n_words``, ``n_removed``, ``removed`` (maximal
    intervals of words from ``start`` up to ``end``) and ``text``: the kept words
    joined by one space.

    Words are what lies between ASCII white space. A null text is the empty one;
    texts shorter than a window stay whole. Rows without ``doc_id`` come before
    all others; rows with equal ids don't take from one another. Only ``doc_id``
    and ``text`` are read. An empty table gives an empty result.

    Texts are shuffled once, packed windows (at most ten bytes each, once per
    batch) once, and those known from earlier batches go back. A batch and a
    range of hashes are what one task holds; a window that a third of all
    documents share is one entry per batch.
    """
    if size < 1:
        raise ValueError("a window has at least one word")
    rows = texts_of(docs)
    weight = F.octet_length("text") + 16
    total = rows.agg(F.sum(weight.cast("bigint"))).first()[0] or 0
    ranges = Buckets(rows, "doc_id", min(MAX_BATCHES, -(-total // batch_bytes)), weight)
    bits = (ranges.count - 1).bit_length()
    batches = rows.withColumn("batch", ranges.column().cast("bigint")).repartition("batch")
    marks = (batches.groupBy("batch").applyInArrow(
                _batch_windows(size, bits), "range long, batch long, windows binary")
             .groupBy("range").applyInArrow(_count, "batch long, windows binary"))
    return (batches.groupBy("batch").cogroup(marks.groupBy("batch"))
            .applyInArrow(_cut(size), RESULT_DDL))
