import pytest

from period_etl.llm import near_dup
from period_etl.llm.common import components
from tests.llm.conftest import rows, words


def shingles(text, k):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(data, k, percent=80):
    sets = [shingles(t, k) for _, t in data]
    parent = list(range(len(data)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[root(i)] = root(j)
    out = []
    for i, (doc, _) in enumerate(data):
        ids = [d for j, (d, _) in enumerate(data) if root(j) == root(i) and d is not None]
        least = min(ids, default=None)
        out.append((doc, len(sets[i]), least, doc == least))
    return sorted(out, key=str)


@pytest.mark.parametrize("k", [4, 5])
def test_components_equal_brute_force(docs, k):
    got = sorted(map(tuple, near_dup.near_duplicates(docs, k=k).collect()), key=str)
    assert got == brute(rows(), k)


def test_group_of_copies_that_drifted_apart(spark):
    """A star: each copy is like the original, most copies are not like each other."""
    base = [f"w{i}" for i in range(200)]
    data = [(0, " ".join(base))]
    for c in range(1, 60):
        w = list(base)
        for j in range(4 if c % 3 else 7):  # the latter are too far from the original
            w[(c * 13 + j * 29) % 196] = f"c{c}x{j}"
        data.append((c, " ".join(w)))
    got = sorted(map(tuple, near_dup.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), k=4).collect()), key=str)
    assert got == brute(data, 4)


def test_signature_of_small_sets_fills_all_bins():
    import numpy as np
    sig = near_dup.signatures(np.array([0, 0, 2]), np.array([5, 9, 5], np.uint64), 3, 160)
    assert (sig[0] != ~np.uint64(0)).all() and len(np.unique(sig[0])) == 2
    assert len(np.unique(sig[2])) == 1


def test_empty_table(no_docs):
    assert near_dup.near_duplicates(no_docs).collect() == []
    assert near_dup.keep_one(no_docs).collect() == []


def test_keep_one_leaves_one_row_of_each_group(docs):
    left = near_dup.keep_one(docs, k=5)
    assert left.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=str)
    want, seen = [], set()
    for doc, text in sorted(rows(), key=lambda r: (r[0] is None, r[0] or 0)):
        group = next(b for b in brute(rows(), 5) if b[0] == doc and b[1] == len(shingles(text, 5)))[2]
        mark = (group, text) if group is None else group
        if not words(text) or mark not in seen and (doc == group or doc is None and group is None):
            want.append((doc, text))
            seen.add(mark)
    # doc 8 has two texts that are not alike: both are first of their group
    want += [(8, t) for d, t in rows() if d == 8 and (8, t) not in want]
    assert got == sorted(want, key=str)


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(100, 160)] + [(7, 7), (3, 2), (3, 2)], "a long, b long")
    got = dict(map(tuple, components(links).collect()))
    assert got == {**dict.fromkeys(range(100, 161), 100), 2: 2, 3: 2}
