"""Near duplicates by b-bit MinHash.

A document is the set of its word shingles. Minima under many hash functions
estimate similarities; bands of them find candidates, and only the low bits of
each are kept, packed, to estimate a pair's similarity by counting equal bits,
corrected for those equal by chance. Candidates above a cautious bound form
families, within which links are confirmed on the full sets.

Large groups are never expanded into pairs: documents with equal sets are one,
a bucket yields a spanning forest of its alike members, and a family a spanning
forest of its confirmed links.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phrasetide.llm.common import SMALL_BYTES, texts_of, without, written
from phrasetide.llm.components import components

SHINGLE = 4
PERCENT = 80  # links: 100 * intersection >= PERCENT * union
HASHES = 128
BITS = 2
# How often, at most, the bands and the cut of estimates each miss a pair whose
# similarity is just PERCENT.
BANDS_MISS, CUT_MISS = 1 / 300_000, 1 / 100_000
# Members of a bucket, and shingles of a family, that one task takes together.
BUCKET_ROWS = 20_000
FAMILY_SHINGLES = 2_000_000

_rng = np.random.Generator(np.random.PCG64(20))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _rng.integers(1, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1)
_WORD = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_FACTORS = (_rng.integers(1, 1 << 31, HASHES, dtype=np.uint64) * 2 + 1).astype(np.uint32)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit values with every bit depending on all bits of ``x``."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@cache
def banding(percent: int) -> tuple[int, int]:
    """Bands and rows of each: as many rows as ``BANDS_MISS`` lets the minima have."""
    for rows in range(HASHES, 0, -1):
        met = (percent / 100) ** rows
        bands = 1 if met >= 1 else math.log(BANDS_MISS) / math.log1p(-met) if met else math.inf
        if bands * rows <= HASHES and math.ceil(bands) * rows <= HASHES:
            return math.ceil(bands), rows
    raise ValueError(f"{HASHES} minima don't find pairs of {percent} percent")


@cache
def least_equal(percent: int) -> int:
    """Equal bit fields a candidate needs: fewer come once in ``1 / CUT_MISS`` at most."""
    chance = 1 / (1 << BITS)
    equal = percent / 100 * (1 - chance) + chance
    below = 0.0
    for n in range(HASHES):
        below += math.comb(HASHES, n) * equal ** n * (1 - equal) ** (HASHES - n)
        if below > CUT_MISS:
            return n
    return HASHES


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash per word of the text, A-Z as a-z."""
    raw = np.frombuffer(text.encode().lower(), np.uint8)
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    places = np.flatnonzero(inside)
    if not len(places):
        return np.zeros(0, np.uint64)
    first = np.ones(len(places), bool)
    first[1:] = np.diff(places) > 1
    starts = np.flatnonzero(first)
    sizes = np.diff(np.append(starts, len(places)))
    at = np.arange(len(places)) - np.repeat(starts, sizes)
    # Words beyond 4,096 bytes take the places in turn, shifted by the turn; only
    # bytes beyond are mixed, so a word's hash depends on that word alone.
    values = _BYTE[raw[places]] * _PLACE[at & 4095] + (at >> 12).astype(np.uint64)
    if sizes.max() > 4096:
        beyond = at > 4095
        values[beyond] = mixed(values[beyond])
    return mixed(np.add.reduceat(values, starts) + sizes.astype(np.uint64))


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """The sorted set of a text's shingles as 64-bit hashes."""
    words = word_hashes(text)
    n = min(size, len(words))
    if not n:
        return words
    runs = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        runs += words[i:len(words) - n + 1 + i] * _WORD[i]
    return np.unique(mixed(runs))


def minima(prints: np.ndarray) -> np.ndarray:
    """The least value of a set of shingles under each hash function."""
    values = (prints >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(values), 2048):
        hashed = values[at:at + 2048, None] * _FACTORS
        hashed ^= hashed >> np.uint32(15)
        np.minimum(least, hashed.min(0), out=least)
    return least


def band_keys(least: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    bands, size = banding(percent)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for row in least[:bands * size].reshape(bands, size).T.astype(np.uint64):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + row)
    return keys.view(np.int64)


def packed_bits(least: np.ndarray) -> bytes:
    """The lowest bits of all minima, in fields of ``BITS``."""
    low = mixed(least.astype(np.uint64)).astype(np.uint8) & ((1 << BITS) - 1)
    bits = (low[:, None] >> np.arange(BITS, dtype=np.uint8)) & 1
    return np.packbits(bits.ravel().astype(bool)).tobytes()


def equal_fields(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many fields are equal, for signatures as rows of 64-bit words."""
    differing = a ^ b
    differing = (differing | (differing >> np.uint64(1))) & np.uint64(0x5555555555555555)
    return HASHES - np.bitwise_count(differing).sum(-1, dtype=np.int64)


def estimated(equal: np.ndarray | int) -> np.ndarray | float:
    """Similarity for a number of equal fields, corrected for chance."""
    chance = 1 / (1 << BITS)
    return (equal / HASHES - chance) / (1 - chance)


SIGNATURE = ("doc_id long, n_shingles long, digest binary, bands array<long>, bits binary")


def _signatures(size: int, percent: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, bands, bits = [], [], [], []
            for text in batch.column("text").to_pylist():
                prints = shingles(text, size)
                least = minima(prints)
                sizes.append(len(prints))
                digests.append(hashlib.sha256(prints.tobytes()).digest()[:16])
                bands.append(band_keys(least, percent))
                bits.append(packed_bits(least))
            flat = np.concatenate(bands) if bands else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(
                np.arange(len(sizes) + 1, dtype=np.int32) * banding(percent)[0], pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()),
                 pa.array(digests, pa.binary()), lists, pa.array(bits, pa.binary())],
                names=["doc_id", "n_shingles", "digest", "bands", "bits"])
    return sign


def signatures(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: size and digest of its set, band keys and packed low bits."""
    return texts_of(docs).mapInArrow(_signatures(size, percent), SIGNATURE)


def _sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of whole groups of rows that are sorted by ``keys``."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([held, rows]) if held is not None else rows
        if not rows.num_rows:
            continue
        same = np.ones(rows.num_rows, bool)
        for key in keys:
            values = rows.column(key).to_numpy()
            same &= values == values[-1]
        whole = rows.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
        if whole:
            yield rows.slice(0, whole).combine_chunks()
        held = rows.slice(whole)
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def _bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where groups begin, and the end."""
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for key in keys:
        values = table.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)


def _fixed(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Binary values of equal width as rows of 64-bit words."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, width)


def _alike(bits: np.ndarray, sizes: np.ndarray, x, others, percent: int) -> np.ndarray:
    small, large = np.minimum(sizes[x], sizes[others]), np.maximum(sizes[x], sizes[others])
    equal = equal_fields(bits[x], bits[others])
    return (equal >= least_equal(percent)) & (100 * small >= percent * large)


def _forest(bits: np.ndarray, sizes: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the alike members of a bucket."""
    left = np.arange(len(sizes))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            hit = _alike(bits, sizes, x, left, percent)
            yield from ((x, y) for y in left[hit])
            queue.extend(left[hit])
            left = left[~hit]


def _candidates(percent: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _sorted_groups(batches, ["key", "part"]):
            bounds = _bounds(rows, ["key", "part"])
            counts = np.diff(bounds)
            if not (counts > 1).any():
                continue
            ids, sizes = rows.column("doc").to_numpy(), rows.column("n").to_numpy()
            bits = _fixed(rows.column("bits"), HASHES * BITS // 64)
            pairs = bounds[:-1][counts == 2]
            hit = pairs[_alike(bits, sizes, pairs, pairs + 1, percent)]
            a, b = [ids[hit]], [ids[hit + 1]]
            for at, n in zip(bounds[:-1][counts > 2], counts[counts > 2]):
                found = list(_forest(bits[at:at + n], sizes[at:at + n], percent))
                if found:
                    edges = np.array(found) + at
                    a.append(ids[edges[:, 0]])
                    b.append(ids[edges[:, 1]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])
    return find


def _in_parts(rows: DataFrame, blocks: str, block_by: str) -> DataFrame:
    """Groups of several ``blocks`` as pairs of blocks, numbered in ``part``.

    Every two rows of a group meet in some part, and no part holds more than two
    blocks. Groups of one block stay whole, as part 0.
    """
    n = F.col(blocks)
    own = F.pmod(F.xxhash64(block_by), n)
    parts = F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1),
                        lambda p: F.least(p, own) * n + F.greatest(p, own))
    return (rows.withColumn("block", own)
            .withColumn("part", F.explode(F.when(n > 1, parts)
                                          .otherwise(F.array(F.lit(0).cast("bigint"))))))


def candidate_links(signed: DataFrame, percent: int = PERCENT,
                    bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links ``a``, ``b`` that connect all documents alike in some bucket.

    Buckets of more than ``bucket_rows`` members are compared by pairs of blocks
    in separate tasks; no member is left out.
    """
    rows = signed.select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), "bits",
                         F.explode("bands").alias("key"))
    heavy = written(signed.select(F.explode("bands").alias("key")).groupBy("key")
                    .agg(F.count("*").alias("members")).filter(F.col("members") > bucket_rows)
                    .select(F.col("key").alias("heavy_key"),
                            F.ceil(F.col("members") / bucket_rows).alias("blocks")), "heavy")
    if heavy.isEmpty():
        rows = rows.withColumn("part", F.lit(0).cast("bigint"))
    else:
        rows = (rows.join(heavy, F.col("key") == F.col("heavy_key"), "left")
                .withColumn("blocks", F.coalesce("blocks", F.lit(1)).cast("bigint")))
        rows = _in_parts(rows, "blocks", "doc")
    return (rows.select("key", "part", "doc", "n", "bits")
            .repartition("key", "part").sortWithinPartitions("key", "part", "doc")
            .mapInArrow(_candidates(percent), "a long, b long"))


def _sets(size: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(text, size).tobytes() for text in batch.column("text").to_pylist()]
            right = [hashlib.sha256(s).digest()[:16] == d
                     for s, d in zip(sets, batch.column("digest").to_pylist())]
            made = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("family"), batch.column("blocks"),
                 pa.array(sets, pa.binary())], names=["doc", "family", "blocks", "prints"])
            yield made.filter(pa.array(right, pa.bool_()))
    return make


def confirmed(sets: list[np.ndarray], blocks: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among sets; across blocks only if there are two."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    cross = len(np.unique(blocks)) > 1
    group = np.arange(n)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    numbers = shared = None
    edges = []
    for x in range(n - 1):
        others = np.flatnonzero(group[x + 1:] != group[x]) + x + 1
        if cross:
            others = others[blocks[others] != blocks[x]]
        small = np.minimum(sizes[x], sizes[others])
        others = others[100 * small >= percent * np.maximum(sizes[x], sizes[others])]
        if not len(others):
            continue
        if len(others) <= 4:
            common = np.array([sizes[x] + sizes[y] - len(np.unique(np.concatenate(
                [sets[x], sets[y]]))) for y in others])
        else:
            if numbers is None:
                distinct, numbers = np.unique(np.concatenate(sets), return_inverse=True)
                shared = np.zeros(len(distinct), np.int32)
            own = numbers[starts[x]:starts[x] + sizes[x]]
            shared[own] = 1
            common = np.add.reduceat(shared[numbers], starts)[others]
            shared[own] = 0
        linked = others[100 * common >= percent * (sizes[x] + sizes[others] - common)]
        for y in linked:
            if group[y] != group[x]:
                edges.append((x, y))
                group[group == group[y]] = group[x]
    return edges


def _confirm(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _sorted_groups(batches, ["family", "part"]):
            bounds = _bounds(rows, ["family", "part"])
            ids, blocks = rows.column("doc").to_numpy(), rows.column("block").to_numpy()
            part, count = rows.column("part").to_numpy(), rows.column("blocks").to_numpy()
            a, b = [], []
            for at, end in zip(bounds[:-1], bounds[1:]):
                sets = [np.frombuffer(p, np.uint64)
                        for p in rows.column("prints").slice(at, end - at).to_pylist()]
                one_block = count[at] == 1 or part[at] // count[at] == part[at] % count[at]
                found = confirmed(sets, blocks[at:end] * (not one_block), percent)
                a += [ids[at + x] for x, _ in found]
                b += [ids[at + y] for _, y in found]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                             names=["a", "b"])
    return confirm


def confirmed_links(docs: DataFrame, signed: DataFrame, families: DataFrame,
                    percent: int = PERCENT, size: int = SHINGLE,
                    family_shingles: int = FAMILY_SHINGLES) -> DataFrame:
    """Links ``a``, ``b`` that connect all documents of a family with links between them.

    Families of more than ``family_shingles`` shingles are compared by pairs of
    blocks in separate tasks.
    """
    members = written(signed.select("doc_id", "n_shingles", "digest").join(
        families.select(F.col("node").alias("doc_id"), F.col("component").alias("family")),
        "doc_id"), "members")
    sizes = written(members.groupBy("family").agg(
        F.ceil(F.sum("n_shingles") / family_shingles).alias("blocks")), "family-sizes")
    wanted = written(members.join(sizes, "family")
                     .select(F.col("doc_id").alias("id"), "digest", "family", "blocks"), "wanted")
    if wanted.count() * 48 <= SMALL_BYTES:
        wanted = F.broadcast(wanted)
    texts = (texts_of(docs).join(wanted, F.col("doc_id") == F.col("id"))
             .select("doc_id", "text", "digest", "family", "blocks"))
    sets = texts.mapInArrow(_sets(size), "doc long, family long, blocks long, prints binary")
    return (_in_parts(sets, "blocks", "doc")
            .repartition("family", "part").sortWithinPartitions("family", "part", "doc")
            .mapInArrow(_confirm(percent), "a long, b long"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE,
                    bucket_rows: int = BUCKET_ROWS,
                    family_shingles: int = FAMILY_SHINGLES) -> DataFrame:
    """Per document: size of its shingle set, its component, and whether it stays.

    Words are runs of characters other than ASCII white space, with A-Z as a-z.
    A text of fewer than ``size`` words has its whole sequence as only shingle;
    one without words (or null) has none, and is alone. A component is named by
    its smallest ``doc_id``, which stays. Equal sets are always linked. Rows
    sharing one id are taken as linked. An empty table gives an empty result.
    """
    signed = written(signatures(docs, size, percent), "signatures")
    classes = written(signed.filter("n_shingles > 0").groupBy("digest")
                      .agg(F.min("doc_id").alias("first_id")), "classes")
    kept = classes.select(F.col("first_id"), F.col("digest").alias("first_digest"))
    first = written(signed.join(kept, (F.col("doc_id") == F.col("first_id"))
                                & (F.col("digest") == F.col("first_digest")), "left_semi"),
                    "classes-signed")
    families = components(written(candidate_links(first, percent, bucket_rows), "candidates"))
    links = confirmed_links(docs, first, families, percent, size, family_shingles)
    joined = written(classes.join(
        components(written(links, "confirmed")).withColumnRenamed("node", "first_id"),
        "first_id", "left")
        .select(F.col("digest").alias("class"),
                F.coalesce("component", "first_id").alias("component")), "class-components")
    component = F.coalesce("component", "doc_id")
    return (signed.select("doc_id", "n_shingles", "digest")
            .join(joined, F.col("digest") == F.col("class"), "left")
            .select("doc_id", "n_shingles", component.alias("component_id"),
                    F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")))


def keep_one(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """``docs`` with one document of each component; all columns stay."""
    made = near_duplicates(docs, percent, size)
    return without(docs, made.filter(~F.col("kept")).select("doc_id"))
