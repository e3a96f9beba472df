from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from phrasetide.llm import merkle, token_files
from phrasetide.llm.bpe import codec
from phrasetide.llm.common import Buckets, up_to
from public_tokenizers import path

LOW, HIGH = -(1 << 63), (1 << 63) - 1
_draw = random.Random(3)
KEYS = {
    "whole span": [LOW, HIGH, *(_draw.randint(LOW, HIGH) for _ in range(2000))],
    "below 2^63": [*(_draw.randint(0, HIGH) for _ in range(300)), HIGH],
    "2^60 wide": [*(_draw.randint(0, 1 << 60) for _ in range(300)), 1 << 60],
    "one far id": [*range(3000), HIGH],
    "far below": [LOW, *range(HIGH - 3000, HIGH)],
    "dense sources": [(s << 48) + i for s, n in ((1, 2000), (77, 900), (4000, 50))
                      for i in range(n)],
    "two dense ends": [*range(LOW, LOW + 900), *range(HIGH - 1000, HIGH)],
}


@pytest.mark.parametrize("kind", KEYS)
@pytest.mark.parametrize("count", [1, 7, 40])
def test_buckets_keep_order_and_size(spark, kind, count):
    keys = KEYS[kind]
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(3)
    made = Buckets(df, "k", count)
    rows = df.select("k", made.column().alias("b")).collect()
    assert len(rows) == len(keys)
    in_order = [r.b for r in sorted(rows, key=lambda r: r.k)]
    assert in_order == sorted(in_order) and set(in_order) == set(range(made.count))
    assert max(Counter(in_order).values()) <= 2 * len(keys) / count + 1
    for b in range(made.count):
        assert made.first[b] == min(r.k for r in rows if r.b == b)


def test_repeated_and_null_keys_share_a_bucket(spark):
    keys = [5] * 400 + [None] * 30 + list(range(600))
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    made = Buckets(df, "k", 8)
    rows = df.select("k", made.column().alias("b")).collect()
    assert len({r.b for r in rows if r.k == 5}) == 1 and made.first[0] is None
    assert {r.b for r in rows if r.k is None} == {0}
    others = Counter(r.b for r in rows if r.k != 5)
    assert max(others.values()) <= 2 * len(keys) / 8 + 30


def test_weights_and_empty_tables(spark):
    df = spark.createDataFrame([(i, 1000 if i < 10 else 1) for i in range(1000)], "k long, w long")
    made = Buckets(df, "k", 5, F.col("w"))
    sums = df.groupBy(made.column().alias("b")).agg(F.sum("w").alias("w")).collect()
    assert made.count == 5 and max(r.w for r in sums) <= 2 * 10990 / 5 + 1000
    assert Buckets(df.filter("false"), "k", 5).count == 1
    nulls = Buckets(df.select(F.lit(None).cast("long").alias("k")), "k", 5)
    assert (nulls.count, nulls.first) == (1, {0: None})


def test_up_to_counts_borders(spark):
    borders = [LOW, -5, 0, 3, HIGH]
    df = spark.createDataFrame([(k,) for k in [None, LOW, LOW + 1, -5, 2, 3, HIGH - 1, HIGH]],
                               "k long")
    made = df.select(up_to(F.col("k"), borders)).collect()
    assert [r[0] for r in made] == [0, 1, 1, 2, 3, 4, 4, 5]


@pytest.mark.parametrize("kind", ["whole span", "below 2^63", "one far id", "dense sources"])
def test_ordered_operators_on_wide_ids(docs, spark, tmp_path, kind):
    keys = sorted(set(KEYS[kind]))[::7] + [max(KEYS[kind])]
    keys = sorted(set(keys))
    texts = [f"Text {i} of some words. " * (1 + i % 3) for i in range(len(keys))]
    table = docs(*zip(keys, texts))
    made = {r.doc_id: r for r in merkle.half_edits(table).collect()}
    assert len(made) == len(keys)
    for i, (key, text) in enumerate(zip(keys, texts)):
        after, half = texts[(i + 1) % len(texts)], len(text) // 2
        new = text[:len(text) - half] + after[:half]
        assert made[key].edited_fingerprint == str(merkle.Tree(new))
        assert made[key].near_next == merkle.likeness(made[key].fingerprint,
                                                      str(merkle.Tree(after)))
    folder = f"file://{tmp_path}/tokens"
    vocabulary = path("byte_bpe_50k.json")
    token_files.write_tokens(table, folder, vocabulary)
    found = sorted(token_files.read_documents(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == keys
    start = 0
    for row, text in zip(found, texts):
        assert row.start == start
        assert row.ids == codec(vocabulary).encode(text) + b"\0\0\0\0"
        start += len(row.ids) // 4
