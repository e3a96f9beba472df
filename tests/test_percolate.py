from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from phrasetide.operators import lookup
from phrasetide.operators import percolate as p


def titles(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, title string")


def pairs(df):
    return sorted((r["id"], r["query"]) for r in df.select("id", "query").collect())


def brute(texts, queries):
    def toks(s):
        return re.findall(r"[^\W]+", s.lower())

    def inside(words, sought):
        return any(words[i:i + len(sought)] == sought for i in range(len(words) - len(sought) + 1))
    return sorted((i, q) for i, t in enumerate(texts) for q in set(queries)
                  if toks(q) and inside(toks(t), toks(q)))


BOTH = pytest.mark.parametrize("limit", [lookup.BROADCAST_BYTES, 0])


@BOTH
@pytest.mark.parametrize("query, title, hit", [
    ("york", "new york", True), ("ork", "new york", False), ("york new", "new york", False),
    ("new york", "brand NEW, York!", True), ("THE", "the end", True), ("!!!", "wow !!!", False),
    ("a b c d e", "x a b c d e y", True), ("a b c d e", "a b c d x e", False),
    ("a b c d", "a b c b c d", False), ("don't", "i don't", True), ("été", "L'ÉTÉ", True),
    ("x", "", False), ("x", None, False)])
def test_phrase_rules(spark, registry, limit, query, title, hit):
    found = p.percolate(titles(spark, title), registry(query), limit=limit)
    assert found.count() == int(hit)


@BOTH
def test_phrase_twice_in_a_title_is_one_row(spark, registry, limit):
    posts = titles(spark, "go go go", "one two three four and one two three four")
    found = p.percolate(posts, registry("go", "go go", "one two three four"), limit=limit)
    assert pairs(found) == [(0, "go"), (0, "go go"), (1, "one two three four")]


@BOTH
def test_spellings_of_one_phrase_all_match(spark, registry, limit):
    found = p.percolate(titles(spark, "the end"), registry("the", "THE", "the!", "The End"), limit=limit)
    assert [q for _, q in pairs(found)] == sorted(["the", "THE", "the!", "The End"])


@BOTH
def test_empty_registry_matches_nothing(spark, registry, limit):
    none = registry("!!!")
    assert p.percolate(titles(spark, "a b"), none, limit=limit).columns == ["id", "title", "query"]
    assert p.percolate(titles(spark, "a b"), none, limit=limit).count() == 0
    assert p.match_counts(titles(spark, "a b"), none, limit=limit).count() == 0
    assert p.percolate_top(titles(spark, "a b"), none, limit=limit).count() == 0


@BOTH
@pytest.mark.parametrize("n, kept", [(0, 0), (5, 5), (6, 5)])
def test_cap_at_five(spark, registry, limit, n, kept):
    posts = titles(spark, " ".join("abcdef"[:n]) + " zz")
    known = registry(*"abcdef")
    top = p.percolate_top(posts, known, limit=limit).orderBy("rank").collect()
    assert [r.query for r in top] == list("abcde")[:kept]
    counts = p.match_counts(posts, known, limit=limit).collect()
    assert [(r.match_total, r.capped) for r in counts] == ([(n, kept)] if n else [])


def test_cap_counts_all_spellings(spark, registry):
    known = registry(*[f"the{'!' * i}" for i in range(9)], "a")
    posts = titles(spark, "the a")
    assert [r.query for r in p.percolate_top(posts, known).orderBy("rank").collect()] == \
        ["a", "the", "the!", "the!!", "the!!!"]
    assert p.match_counts(posts, known).first().match_total == 10


def test_posts_without_a_key_are_left_out(spark, registry):
    posts = spark.createDataFrame([(None, "a"), (1, "a")], "id long, title string")
    for limit in (lookup.BROADCAST_BYTES, 0):
        assert pairs(p.percolate(posts, registry("a"), limit=limit)) == [(1, "a")]


def test_matched_ids_and_nested_form(spark, registry):
    posts, known = titles(spark, "a b", "c", "b"), registry("a", "b", "x")
    assert sorted(r.id for r in p.matched_ids(posts, known).collect()) == [0, 2]
    nested = p.nested_matches(posts, known)
    first = nested.filter("id = 0").first()
    assert (first.total, [m["_id"] for m in first.matches]) == (2, ["a", "b"])
    assert pairs(p.expand_matches(nested)) == [(0, "a"), (0, "b"), (2, "b")]
    assert p.hit_ids(nested).filter("id = 0").first().matches == ["a", "b"]


def test_shared_openings_are_filed_apart(spark, registry):
    queries = [f"how to make {w} at home" for w in ("bread", "cheese", "wine", "ink")]
    index = p.index_phrases(p.phrases(registry(*queries)))
    filed = {r.query: r.gram for r in index.rows.collect()}
    assert len(set(filed.values())) == 4 and "how to make" not in filed.values()


def test_hot_word_in_every_post(spark, registry):
    """A third of all grams share one key; both ways keep every row."""
    texts = ["the"] * 300 + [f"w{i} the" for i in range(300)]
    known = registry("the", *[f"w{i}" for i in range(300)])
    want = brute(texts, ["the", *[f"w{i}" for i in range(300)]])
    for limit in (lookup.BROADCAST_BYTES, 0):
        assert pairs(p.percolate(titles(spark, *texts), known, limit=limit)) == want


words = st.lists(st.sampled_from(["a", "b", "c", "the", "É", "x1", "_"]), min_size=0, max_size=8)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(words, min_size=1, max_size=6), st.lists(words, min_size=1, max_size=8))
def test_both_ways_equal_brute_force(spark, registry, texts, queries):
    texts = [" - ".join(t) for t in texts]
    queries = sorted({" ".join(q) for q in queries})
    want = brute(texts, queries)
    for limit in (lookup.BROADCAST_BYTES, 0):
        assert pairs(p.percolate(titles(spark, *texts), registry(*queries), limit=limit)) == want


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_is_the_same_either_way(spark, how):
    big = spark.range(400).selectExpr("id as doc", "if(id < 250, 'hot', concat('k', id % 7)) as k")
    small = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("k9", 4)], "k string, v int")
    near = lookup.lookup_join(big, small, ["k"], how, ["doc"])
    far = lookup.lookup_join(big, small, ["k"], how, ["doc"], limit=0)
    assert near.columns == far.columns
    assert sorted(near.collect(), key=str) == sorted(far.collect(), key=str)
