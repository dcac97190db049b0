import math
import re
from collections import Counter

import numpy as np
import pytest

from period_etl.llm import ranked
from tests.llm.conftest import prose, rows

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(data, items, k=10):
    docs = [(d, Counter(split(t))) for d, t in data if split(t)]
    n_docs, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in docs:
            m = 10 + 90 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(split(text)) if c[t])
            if score > 0:
                scored.append((-score, d is not None, d or 0, d))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return out


ITEMS = [(1, prose(0, 40)), (2, prose(3, 200)), (3, ""), (4, None), (5, "no such terms anywhere"), (6, "ONE two, one!"), (7, "漢字 Ünd é"), (2, "word"),
         (None, "x" * 50_000), (9, prose(99, 300)), (10, prose(500, 90).upper())]


@pytest.mark.parametrize("size", [(1 << 19, 1 << 14, 4 << 20), (40, 600, 500)])
def test_equals_scoring_every_document(docs, spark, size):
    """In one segment and one block, and in many."""
    items = spark.createDataFrame(ITEMS, "item_id long, text string").repartition(2)
    got = [tuple(r) for r in ranked.ranked_search(docs, items, segment=size[0], segment_docs=size[1], block_bytes=size[2]).collect()]
    assert sorted(got, key=str) == sorted(brute(rows(), ITEMS), key=str)


def test_ties_and_small_k(spark):
    data = [(i, "same words here") for i in range(40, 0, -1)] + [(None, "same words here"), (99, "other"), (98, "other things")]
    docs, items = spark.createDataFrame(data, "doc_id long, text string").repartition(4), spark.createDataFrame([(0, "words same"), (1, "other")], "item_id long, text string")
    for k in (1, 3, 10, 100):
        got = [tuple(r) for r in ranked.ranked_search(docs, items, k=k, segment_docs=600, segment=7).collect()]
        assert sorted(got, key=str) == sorted(brute(data, [(0, "words same"), (1, "other")], k), key=str)


def test_empty_tables(no_docs, docs, spark):
    none, some = spark.createDataFrame([], "item_id long, text string"), spark.createDataFrame([(1, "some words")], "item_id long, text string")
    assert ranked.ranked_search(no_docs, some).collect() == [] and ranked.ranked_search(docs, none).collect() == []


def test_range_maxima():
    rng = np.random.default_rng(0)
    term, doc = np.divmod(np.sort(rng.choice(5 * 60, 150, replace=False)), 60)
    lists = ranked.Postings(term, doc, rng.integers(1, 9, 150), 5, 60)
    for t in range(5):
        a, b = lists.edge[t:t + 2]
        for lo in range(a, b + 1):
            for hi in range(lo, b + 1):
                most, where = lists.maxima(np.array([[lo]]), np.array([[hi]]))
                assert most[0, 0] == lists.impact[lo:hi].max(initial=0) and (lo == hi or lists.impact[where[0, 0]] == most[0, 0])


def test_search_leaves_documents_unscored(monkeypatch):
    """Bounds of intervals below the best scores end the search: a rare term's documents are enough."""
    n = 4096
    term = np.repeat([0, 1], [n, 8])
    doc = np.concatenate([np.arange(n), np.arange(8) * 500])
    lists = ranked.Postings(term, doc, np.where(term == 1, 900, 10), 2, n)
    looked = []
    at = lists.at
    monkeypatch.setattr(lists, "at", lambda t, d: looked.append(len(d)) or at(t, d))
    found, score = lists.search(np.array([0, 1]), 8, 0)
    assert sorted(found) == sorted(doc[n:]) and set(score) == {910} and sum(looked) < n / 8
