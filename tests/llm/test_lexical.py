"""Ranked lexical search against a plain evaluation, and the sharing graph by itself."""

import math
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from devpulse.llm import lexical, queries
from tests.oracle_harness import compare, duck

SF001 = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans(queries.UPPER, queries.LOWER)


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k):
    listed = [(key, terms(t)) for key, t in docs]
    n, total = sum(bool(t) for _, t in listed), sum(len(t) for _, t in listed)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, ts in wanted.items():
        scored = []
        for key, words in listed:
            m, score = 50 + 50 * len(words) * n // max(1, total), 0
            for t in ts & set(words):
                df = sum(t in w for _, w in listed)
                tf = words.count(t)
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * (10**9 * tf // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((-score, key is None, key or 0))
        out += [(item, r, None if empty else key, -s) for r, (s, empty, key) in enumerate(sorted(scored)[:k], 1)]
    return out


@given(st.text(st.one_of(st.sampled_from("aZ09_-'éİ\x00 \t"), st.characters(codec="utf-8")), max_size=40))
@settings(max_examples=200, deadline=None, derandomize=True)
def test_terms_follow_the_pattern(text):
    assert [t.decode() for t in lexical.terms(text)] == terms(text)


@given(st.lists(st.sets(st.integers(0, 14), max_size=10), max_size=12))
@settings(max_examples=200, deadline=None, derandomize=True)
def test_the_graph_sums_to_every_set_and_never_costs_more(sets):
    sums, parts = lexical.sharing_graph([sorted(s) for s in sets], 15)
    leaves = [{i} for i in range(15)]
    for a, b in sums:
        assert not leaves[a] & leaves[b]
        leaves.append(leaves[a] | leaves[b])
    for s, p in zip(sets, parts):
        assert sorted(x for a in p for x in leaves[a]) == sorted(s)
    plain_cost, shared = lexical.additions(sets, sums, parts)
    assert shared <= plain_cost


def test_shared_sets_are_summed_once():
    sets = [[0, 1, 2, i] for i in range(3, 23)]
    sums, parts = lexical.sharing_graph(sets, 23)
    assert lexical.additions(sets, sums, parts) == (60, 22) and all(len(p) == 2 for p in parts)


ODD = [(1, "Alpha beta-gamma alpha"), (2, None), (3, ""), (4, " \t.;"), (5, "alpha beta " * 4000), (6, "éa ÉA x y İ"),
       (6, "éa ÉA x y İ"), (None, "beta gamma"), (9, "ALPHA"), (10, "alpha")]
ITEMS = [(1, "alpha beta"), (2, None), (3, "unknown words"), (4, "beta gamma éa"), (4, "x y"), (None, "alpha beta gamma")]


@pytest.mark.parametrize("k", [1, 3, 50])
def test_odd_rows_equal_plain(spark, k):
    docs = spark.createDataFrame([(*r, 1, "i", 5) for r in ODD], "doc_id long, text string, item int, term string, score long")
    items = spark.createDataFrame([(*r, "d") for r in ITEMS], "item_id long, text string, doc_id string")
    got = [tuple(r) for r in lexical.search(docs.repartition(3), items, k).collect()]
    assert sorted(got, key=str) == sorted(plain(ODD, ITEMS, k), key=str)


def test_random_rows_over_several_blocks(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choices(words, range(60, 0, -1), k=rng.randrange(40)))) for i in range(300)]
    items = [(i, " ".join(rng.sample(words, 12))) for i in range(30)]
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 100)
    monkeypatch.setattr(lexical, "SLICE", 1 << 14)
    monkeypatch.setattr(lexical, "KEPT", 200)
    got = lexical.search(spark.createDataFrame(docs, "doc_id long, text string"),
                         spark.createDataFrame(items, "item_id long, text string"), 20)
    assert sorted(map(tuple, got.collect())) == sorted(plain(docs, items, 20))


def test_empty_tables(spark):
    docs, items = spark.createDataFrame(ODD, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.search(docs.limit(0), items, 5).count() == 0
    assert lexical.search(docs, items.limit(0), 5).count() == 0


def test_query_matches_sql(spark):
    name = "op11_lexical_search"
    n, problems = compare(spark, duck(SF001), queries.QUERIES[name], queries.ORACLE_SQL[name], SF001)
    assert n and not problems
