"""Names found by an automaton and by a join of hashes, against a search for each name."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from manifest_spark.operators import names as N


def searched(docs, names):
    return sorted((d, n, t.find(n) + 1) for d, t in docs for n in set(names) if t and n and n in t)


def both(spark, docs, names):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    n = spark.createDataFrame([(x,) for x in names], "name string")
    for found in (N.find_names(d, n), N.find_names(d, n, most_names=0), N.by_join(d, n, filter_bits=10)):
        assert sorted(tuple(r) for r in found.collect()) == searched(docs, names)


def test_names_of_all_lengths(spark):
    rng = random.Random(1)
    names = [None, "", "a", "ab", "ba", "aba", "été", "日本", "😀x", "Customer 1", "Customer 12", "Customer 123", "x" * 70, "x" * 63, "ACME CORP"]
    names += ["".join(rng.choice("ab ") for _ in range(rng.randint(1, 40))) for _ in range(60)]
    docs = [(i, "".join(rng.choice(["a", "b", " ", "été", "日本", "😀x", "Customer 12", "XACME CORPORATION", "x" * 66]) for _ in range(rng.randint(0, 60))))
            for i in range(80)]
    both(spark, docs + [(900, None), (901, ""), (902, "Customer 1234\n" * 20_000)], names)


def test_no_names_or_documents(spark):
    both(spark, [(1, "a text")], [])
    both(spark, [], ["a"])


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40), st.integers(1, 9))
def test_equal_runs_have_equal_hashes(t, m):
    signs = N._signs(t)
    h = N.grams(signs, m)
    assert len(h) == max(0, len(signs) - m + 1)
    for i in range(len(h)):
        assert h[i] == N.grams(signs[i:i + m], m)[0]


def test_distinct_runs_have_distinct_hashes():
    rng = np.random.default_rng(1)
    h = N.grams(rng.integers(32, 127, 100_000).astype("<u4"), 16)
    assert len(np.unique(h)) == len(h)


def test_sites_of_a_table(spark):
    docs = spark.createDataFrame([(1, "to WEST YARD\nAddress:\n 1 Mill Rd \n Town, NY 12345\nand EAST YARD"), (2, "EAST YARD"), (3, "none"), (4, None)],
                                 "doc_id long, text string")
    sites = spark.createDataFrame([(7, "EAST YARD"), (5, "WEST YARD"), (9, None), (1, "NORTH")], "site_id long, name string")
    got = sorted(tuple(r) for r in N.site_parties(docs, sites).collect())
    assert got == [(1, 5, "WEST YARD", "1 Mill Rd, Town, NY 12345"), (2, 7, "EAST YARD", None)]
