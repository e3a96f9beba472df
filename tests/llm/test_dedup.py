from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from phrasetide.llm import components, exact_dedup, line_dedup, minhash
from tests.llm.conftest import TEXTS

SPACE = re.compile(r"[\x20\x09-\x0D]")


@given(st.lists(st.integers(0, 2**64 - 1)), st.lists(st.integers(0, 40)))
@settings(max_examples=200, deadline=None)
def test_merged_filters_count_exactly(wide, narrow):
    values = [*wide, *(n << 58 for n in narrow), *narrow, *wide[:3]]
    want = defaultdict(int)
    for v in values:
        want[v] += 1

    def made(part):
        arr = np.array(part, np.uint64)
        return exact_dedup.QuotientFilter.of(
            *exact_dedup.summed(arr, np.ones(len(arr), np.int64)))

    merged = made(values[::2]).merged(made(values[1::2]))
    again = exact_dedup.QuotientFilter.from_bytes(merged.to_bytes())
    prints, counts = again.entries()
    assert dict(zip(prints.tolist(), counts.tolist())) == dict(want)
    assert prints.tolist() == sorted(want)


def exact_brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[SPACE.sub("", text or "")].append((-len(text or ""), doc_id))
    return {doc_id: (min(found)[1], len(found), hashlib.sha256(body.encode()).hexdigest())
            for body, found in groups.items() for _, doc_id in found}


@pytest.mark.parametrize("small", [exact_dedup.SMALL_BYTES, -1])
def test_exact_groups_equal_brute_force(docs, monkeypatch, small):
    monkeypatch.setattr(exact_dedup, "SMALL_BYTES", small)
    rows = [*enumerate(TEXTS), *((100 + i, f"x {i % 4}" + " " * (i % 3)) for i in range(40))]
    want = exact_brute(rows)
    got = exact_dedup.duplicate_groups(docs(*rows, parts=5)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.keep_id, r.group_size, r.text_sha256) == want[r.doc_id]
        assert r.kept == (r.keep_id == r.doc_id)


def test_shared_fingerprints_are_told_apart_by_bytes(docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "_filters", exact_dedup._filters)
    frame = docs("a", "b", "a")
    hashed = exact_dedup.hashed

    def collide(rows):
        from pyspark.sql import functions as F
        return hashed(rows).withColumn("print", F.lit(7).cast("long"))

    monkeypatch.setattr(exact_dedup, "hashed", collide)
    got = sorted((r.doc_id, r.keep_id, r.group_size)
                 for r in exact_dedup.duplicate_groups(frame).collect())
    assert got == [(0, 0, 2), (1, 1, 1), (2, 0, 2)]


def test_exact_odd_tables(empty, clashing):
    assert exact_dedup.duplicate_groups(empty).count() == 0
    kept = exact_dedup.keep_one(clashing("a", "a ", None, ""))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2] and "kept" in kept.columns
    assert exact_dedup.keep_one(empty).count() == 0


def shingle_set(text, size):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def linked(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_brute(rows, size=4):
    sets = {i: shingle_set(t, size) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return sets, linked(links, sets)


def family(rng, size, n):
    """Near copies of one text: some words replaced, some copies of copies."""
    words = [rng.choice("alpha beta gamma delta rho pi chi psi".split()) + str(rng.randrange(99))
             for _ in range(size)]
    texts = [words]
    for _ in range(n - 1):
        copy = list(rng.choice(texts))
        for _ in range(rng.randrange(3)):
            copy[rng.randrange(size)] = f"new{rng.randrange(9999)}"
        texts.append(copy)
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("bucket_rows, family_shingles", [
    (minhash.BUCKET_ROWS, minhash.FAMILY_SHINGLES), (3, 200)])
def test_near_components_equal_brute_force(docs, bucket_rows, family_shingles):
    rng = random.Random(5)
    texts = [*TEXTS, *family(rng, 60, 14), *family(rng, 25, 8), *family(rng, 4, 3),
             "Four words are here", "FOUR  words\tare here", "two words", "Two words"]
    rows = [(7 * i + 1, t) for i, t in enumerate(texts)]
    sets, component = near_brute(rows)
    got = minhash.near_duplicates(docs(*rows, parts=4), bucket_rows=bucket_rows,
                                  family_shingles=family_shingles).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), component[r.doc_id])
        assert r.kept == (r.component_id == r.doc_id)


@given(st.text(alphabet="aBc \t\n\x0b\x1cé", max_size=60), st.integers(1, 5))
@settings(max_examples=200, deadline=None)
def test_shingle_hashes_stand_for_the_set(text, size):
    assert len(minhash.shingles(text, size)) == len(shingle_set(text, size))


def test_long_words_differ_by_every_byte():
    base = "x" * 20_000
    found = {int(minhash.word_hashes(base[:i] + "y" + base[i + 1:])[0])
             for i in range(0, 20_000, 997)}
    assert len(found) == 21


@pytest.mark.parametrize("long_word", ["x" * 4096, "x" * 4097, "ab" * 10_000, "語" * 1366])
def test_shared_shingles_beside_a_long_word(long_word):
    words = [f"w{i % 211}v{i}" for i in range(300)]
    texts = [" ".join(words), " ".join([*words[:100], long_word, *words[100:]]),
             " ".join([long_word, *words[50:]]), f"{long_word}y " + " ".join(words[:250])]
    for a in texts:
        for b in texts:
            want = len(shingle_set(a, 4) & shingle_set(b, 4))
            assert len(np.intersect1d(minhash.shingles(a), minhash.shingles(b))) == want > 0


def test_a_copy_with_a_long_word_is_linked(docs):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(1, text), (2, f"{text} {'QUJD' * 1500}"), (3, "other words that are not alike")]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs(*rows)).collect()}
    assert got == near_brute(rows)[1] == {1: 1, 2: 1, 3: 3}


def test_cut_and_bands_follow_the_percent(docs):
    lost = [math.comb(128, n) * 0.85 ** n * 0.15 ** (128 - n)
            for n in range(minhash.least_equal(80))]
    assert minhash.banding(80) == (24, 4) and 5e-6 < sum(lost) <= 1e-5
    for percent in (20, 50, 80, 95, 100):
        bands, rows = minhash.banding(percent)
        assert bands * rows <= minhash.HASHES
        assert (1 - (percent / 100) ** rows) ** bands <= minhash.BANDS_MISS
    words = [[f"p{p}w{i}" for i in range(200)] for p in range(12)]
    rows = [(2 * p, " ".join(w)) for p, w in enumerate(words)]
    rows += [(2 * p + 1, " ".join([*w[:140], *(f"n{p}v{i}" for i in range(60))]))
             for p, w in enumerate(words)]
    got = minhash.near_duplicates(docs(*rows), percent=50).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i // 2 * 2 for i, _ in rows}


def test_estimates_are_close():
    rng = np.random.default_rng(3)
    for share in (0.5, 0.8, 0.95):
        errors = []
        for _ in range(40):
            common = rng.integers(0, 2**63, int(1000 * share), dtype=np.uint64)
            rest = rng.integers(0, 2**63, (2, (1000 - len(common)) // 2), dtype=np.uint64)
            bits = [np.frombuffer(minhash.packed_bits(minhash.minima(
                np.unique(np.concatenate([common, r])))), np.uint64) for r in rest]
            errors.append(minhash.estimated(minhash.equal_fields(*bits)) - share)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.1


def test_near_odd_tables(empty, clashing):
    assert minhash.near_duplicates(empty).count() == 0
    text = "some words that are repeated here and there"
    kept = minhash.keep_one(clashing(text, text, None, "", text + " again"))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3] and "digest" in kept.columns


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(1)
    links = {"path": [(i, i + 1) for i in range(60)], "star": [(99, i) for i in range(60)],
             "random": [(rng.randrange(80), rng.randrange(80)) for _ in range(50)],
             "none": []}[shape]
    frame = spark.createDataFrame(links, "a long, b long").repartition(3)
    nodes = {n for link in links for n in link if link[0] != link[1]}
    want = linked([x for x in links if x[0] != x[1]], nodes)
    assert {r.node: r.component for r in components.components(frame).collect()} == want


def line_brute(rows):
    seen, out = [], {}
    for doc_id, text in sorted((i, t or "") for i, t in rows):
        kept, lines = [], text.split("\n")
        for line in lines:
            words = frozenset(w for w in re.split(r"[\x20\x09-\x0D]+", line.lower()) if w)
            if not words or not any(5 * len(words & s) >= 4 * len(words | s) for s in seen):
                kept.append(line)
            if words:
                seen.append(words)
        out[doc_id] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


@pytest.mark.parametrize("small", [line_dedup.SMALL_BYTES, -1])
def test_lines_equal_brute_force(docs, monkeypatch, small):
    monkeypatch.setattr(line_dedup, "SMALL_BYTES", small)
    rng = random.Random(9)
    texts = [t for t in TEXTS if len(t or "") < 9000]
    for n in range(30):
        lines = [*family(rng, rng.choice([3, 5, 6, 12, 30]), 2), "shared line of five words"]
        texts.append("\n".join(rng.sample(lines, rng.randrange(1, 4))))
    texts += family(rng, 12, 12) + ["The, the line.", "the the, LINE."]
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    want = line_brute(rows)
    got = line_dedup.without_repeated_lines(docs(*rows, parts=4)).collect()
    assert {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in got} == want


def test_long_similar_lines_equal_brute_force(docs):
    rng = random.Random(5)
    rows = []
    for n in (60, 64, 66, 80, 150, 400):
        base = [f"w{n}x{i}" for i in range(n)]
        for k in range(6):  # up to and beyond a ninth of the words are others
            line = base[rng.randrange(n // 6):] + [f"o{n}y{k}z{i}" for i in range(n // 12)]
            rows.append((len(rows) * 7 % 37, " ".join(rng.sample(line, len(line)))))
    got = line_dedup.without_repeated_lines(docs(*rows)).collect()
    want = line_brute(rows)
    assert {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in got} == want
    assert 0 < sum(removed for _, removed, _ in want.values()) < len(rows)


def test_the_first_round_sends_few_rows(docs):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(100))) for i in range(5)]
    marked = line_dedup._marked(line_dedup._lines(docs(*rows, (9, "a b"), (10, "a b"))))
    sets = marked.filter(F.col("prefix").isNotNull())
    assert sorted(size for size, in sets.select(F.size("prefix")).collect()) == [1] + [21] * 5
    assert line_dedup._first_rows(sets).count() == 5 * line_dedup.FIRST_WORDS + 1


def test_the_first_round_settles_by_the_nearer_of_two(docs):
    base = [f"w{i}" for i in range(12)]
    rows = [(1, " ".join(base[:6] + list("abcdef"))), (2, " ".join(base)), (3, " ".join(base[1:]))]
    table = docs(*rows)
    sets = line_dedup._marked(line_dedup._lines(table)).withColumn("prefix", F.array(F.lit(7)))
    assert [tuple(r) for r in line_dedup._settled_by_first(table, sets).collect()] == [(3, 0)]


def test_sets_of_some_forty_words_have_the_second_bitmap(docs):
    rows = [(n, " ".join(f"w{i}" for i in range(n))) for n in (8, 32, 33, 60)]
    lines = {r.doc_id: r for r in line_dedup._lines(docs(*rows)).collect()}
    assert [lines[n].b1 is None for n, _ in rows] == [True, True, False, False]
    for n, _ in rows:
        flipped = 0
        for token in lines[n].tokens:
            flipped ^= 1 << (token & 63)
        assert lines[n].b0 & (2**64 - 1) == flipped and lines[n].n == n == len(lines[n].tokens)


def test_line_odd_tables(empty, clashing, docs):
    assert line_dedup.without_repeated_lines(empty).count() == 0
    got = line_dedup.without_repeated_lines(clashing("a b\na b", None, "\n")).collect()
    assert {r.doc_id: (r.n_removed, r.text) for r in got} == {0: (1, "a b"), 1: (0, ""), 2: (0, "\n")}
    alone = line_dedup.without_repeated_lines(docs((None, "a b"), (1, "a b"))).collect()
    assert sorted(r.n_removed for r in alone) == [0, 0]


def test_lines_without_python(docs):
    text = line_dedup.without_repeated_lines(docs("a", "a"))._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text


def test_parts_of_a_slice_merge_in_near_linear_work():
    rng = np.random.default_rng(4)
    parts = [np.unique(rng.integers(0, 1 << 40, 40, dtype=np.uint64)) for _ in range(2000)]
    runs = exact_dedup.filter_runs()
    for part in parts:
        runs.add(exact_dedup.QuotientFilter.of(part, np.ones(len(part), np.int64)))
    total = sum(map(len, parts))
    assert runs.touched <= total * (len(parts).bit_length() + 1)
    prints, counts = runs.result().entries()
    want, n = np.unique(np.concatenate(parts), return_counts=True)
    assert (prints == want).all() and (counts == n).all()
    assert exact_dedup.filter_runs().result() is None


def test_rows_without_an_id(docs):
    made = exact_dedup.duplicate_groups(docs((None, "a b"), (None, "a b"), (5, "ab"), (None, "x")))
    rows = sorted(made.collect(), key=lambda r: (r.text_sha256, r.doc_id or 0))
    by_size = {r.group_size for r in rows if r.kept is not None}
    assert by_size == {1, 3} and sum(r.kept for r in rows) == 2 + 1
    assert {r.keep_id for r in rows} == {None}
    made = exact_dedup.duplicate_groups(docs((None, "ab"), (5, "ab"), (6, "a b")))
    assert [(r.doc_id, r.kept) for r in made.filter("kept").collect()] == [(6, True)]
