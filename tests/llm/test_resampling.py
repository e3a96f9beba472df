from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from phrasetide.llm import resampling
from tests.llm.conftest import TEXTS

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows, target, buckets, run, percent, least):
    def features(text):
        words = WORD.findall((text or "").translate(UPPER))
        return len(words), [crc32(" ".join(words[i:i + n]).encode()) % buckets
                            for n in range(1, run + 1) for i in range(len(words) - n + 1)]

    made = [(i, *features(t)) for i, t in rows]
    s = Counter(b for _, _, f in made for b in f)
    t = Counter(b for text in target for b in features(text)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log(
        (t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    scored = []
    for i, n, f in made:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        scored.append((i, n, len(f), weight, weight + math.floor(
            -1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    apt = sorted((-score, i is None, i or 0, n, k) for k, (i, words, n, _, score) in enumerate(scored)
                 if words >= least)
    rank = {k: r + 1 for r, (*_, k) in enumerate(apt[:percent * len(apt) // 100])}
    return [(*row, rank.get(k)) for k, row in enumerate(scored)]


def corpus(n, seed):
    draw = random.Random(seed)
    words = ["The", "of", "Ünder", "x1", "don't", "a-b", "京都", "rare", "common", "word"]
    return [" ".join(draw.choice(words) for _ in range(draw.choice([0, 3, 19, 20, 40, 90])))
            for _ in range(n)]


def key(row):
    return tuple((x is None, x or 0) for x in row)


@pytest.mark.parametrize("run, buckets, percent", [(1, 10_000, 10), (2, 97, 33), (3, 70_000, 100)])
def test_equals_brute_force(docs, spark, run, buckets, percent):
    rows = [(7 * i - 50, t) for i, t in enumerate(corpus(150, run) + TEXTS)]
    target = ["word of the common", None, "", "RARE rare don't"]
    made = resampling.resampled(
        docs(*rows), spark.createDataFrame([(i, t) for i, t in enumerate(target)],
                                           "item_id long, text string"),
        run=run, buckets=buckets, percent=percent)
    want = brute_force(rows, target, buckets, run, percent, 20)
    assert sorted(map(tuple, made.collect()), key=key) == sorted(want, key=key)


def test_null_and_repeated_ids(docs, spark):
    texts = corpus(60, 4)
    rows = [(None if i % 4 == 0 else i // 7, texts[i % 9]) for i in range(60)]
    target = spark.createDataFrame([("the of",)], "text string")
    made = resampling.resampled(docs(*rows), target, percent=40)
    want = brute_force(rows, ["the of"], 10_000, 1, 40, 20)
    assert sorted(map(tuple, made.collect()), key=key) == sorted(want, key=key)


def test_ties_of_scores_go_to_smaller_ids(spark):
    for n_tied, draw in ((50, 1), (50, 49), (50, 50), (50, 53), (3, 2)):
        rows = [(i * 10 - 200, 5) for i in range(n_tied)] + [(i, 9) for i in range(1000, 1003)] + \
            [(i, -3) for i in range(2000, 2010)]
        scores = spark.createDataFrame(rows, "doc_id long, score long").repartition(3)
        score, last = resampling.cutoff(scores, draw)
        inside = [r for r in rows if r[1] > score or (r[1] == score and (last is None or r[0] <= last))]
        assert sorted(inside) == sorted(sorted(rows, key=lambda r: (-r[1], r[0]))[:draw])


def test_extreme_ids_and_all_null_ids_at_the_cutoff(spark):
    low, high = -(1 << 63), (1 << 63) - 1
    scores = spark.createDataFrame([(low, 1), (high, 1), (0, 1)], "doc_id long, score long")
    assert resampling.cutoff(scores, 1) == (1, low)
    assert resampling.cutoff(scores, 2) == (1, 0) and resampling.cutoff(scores, 3) == (1, high)
    scores = spark.createDataFrame([(None, 1), (None, 1), (4, 1)], "doc_id long, score long")
    assert resampling.cutoff(scores, 2) == (1, None) and resampling.cutoff(scores, 1) == (1, 4)


def test_clashing_columns_and_empty_tables(clashing, empty, spark):
    target = spark.createDataFrame([], "text string")
    rows = [(i, "one two three " * 9) for i in range(10)]
    made = resampling.resampled(clashing(*rows), target, percent=20).collect()
    want = brute_force(rows, [], 10_000, 1, 20, 20)
    assert sorted(map(tuple, made), key=key) == sorted(want, key=key)
    none = resampling.resampled(empty, target)
    assert none.count() == 0 and none.columns[-1] == "rank"
    few = resampling.resampled(clashing((1, "too few words")), target)
    assert few.filter(F.col("rank").isNotNull()).count() == 0
