"""Ranked lexical search against a direct loop in Python's integers."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from wardloom.llm import lexical
from wardloom.llm.lexical import Ranking, rank, slices_of, terms_of

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return TERM.findall((text or "").translate(LOWER))


def _brute(docs, items, k):
    held = [(i, Counter(_terms(t))) for i, t in docs if i is not None]
    lengths = [sum(c.values()) for _, c in held]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    df = Counter(t for _, c in held for t in c)
    wanted = []
    merged = {}
    for item, text in items:
        if item is not None:
            merged.setdefault(item, []).extend(_terms(text))
    for item, terms in merged.items():
        scored = []
        for (doc, c), length in zip(held, lengths):
            if length:
                m = 75 + 25 * length * n // total
                score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms if c[t])
                scored += [(-score, doc)] * (score > 0)
        wanted += [(item, r, doc, -s) for r, (s, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(wanted)


DOCS = [
    (1, "The cat sat on the mat"), (2, "the CAT, the cat; the cat!"), (3, None), (4, ""), (5, "  ...  "), (6, "ÉCOLE école 42 foo_bar"), (7, "cat " * 4000), (8, "dog"),
    (9, "dog"), (10, "dog"), (11, "the\x85dog\xa0x"), (11, "dog cat"), (None, "cat dog cat dog"), (12, "A b A b c"), (13, "漢字 漢字かな dog"),
]
ITEMS = [(1, "cat"), (2, "the cat the cat the"), (3, None), (4, ""), (5, "dog dog mat école"), (6, "nowhere words"), (7, "foo bar ÉCOLE"), (None, "cat"), (1, "dog"), (8, "b " * 50_000)]


@pytest.mark.parametrize("ranking", [Ranking(), Ranking(k=2, item_tile=1, term_tile=1, doc_tile=2, pass_items=3), Ranking(k=3, pass_chars=40_000)])
def test_equals_a_direct_loop(spark, ranking):
    docs = spark.createDataFrame([(*r, 0, "x") for r in DOCS], "doc_id long, text string, n long, score string")
    items = spark.createDataFrame([(*r, "x") for r in ITEMS], "item_id long, text string, term string")
    found = sorted(tuple(r) for r in rank(docs, items, ranking=ranking).collect())
    assert found == _brute(DOCS, ITEMS, ranking.k)


def test_empty_tables_and_other_names(spark):
    docs, items = spark.createDataFrame([(1, "a")], "d long, t string"), spark.createDataFrame([("q", "a")], "i string, t string")
    assert [tuple(r)[:3] for r in rank(docs, items, "d", "i", "t").collect()] == [("q", 1, 1)]
    assert rank(docs.where("false"), items, "d", "i", "t").collect() == [] == rank(docs, items.where("false"), "d", "i", "t").collect()


def test_terms_are_cut_as_the_pattern_cuts_them():
    text = "".join(map(chr, range(0x250))) + " 　Z"
    assert [t.decode() for t in terms_of(text.encode())] == _terms(text)


def test_slices_keep_sums_exact():
    rng = np.random.default_rng(0)
    weights = rng.integers(0, 5_000_000_000, (200, 3))
    weights[5, 1] = 40 * lexical.EXACT // lexical.MOST_IMPACT
    found = slices_of(weights, 64)
    whole = np.zeros_like(weights)
    for rows, part in found:
        assert len(rows) <= 64 and (part.sum(axis=0) * lexical.MOST_IMPACT < lexical.EXACT).all()
        np.add.at(whole, rows, part.astype(np.int64))
    assert (whole == weights).all()


def test_ties_across_tiles_and_tasks(spark):
    rows = [(i, "same words here") for i in range(500, 0, -1)] + [(1000, "others")]
    docs, items = spark.createDataFrame(rows, "doc_id long, text string").repartition(7), spark.createDataFrame([(0, "words")], "item_id long, text string")
    assert [r.doc_id for r in rank(docs, items, ranking=Ranking(doc_tile=16)).orderBy("rank").collect()] == list(range(1, 21))
