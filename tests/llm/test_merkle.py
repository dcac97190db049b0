import zlib
from hashlib import sha256

import pytest

from period_etl.llm import merkle
from tests.llm.conftest import DOCS, rows


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(doc, text, lang, source, n):
    return H(*map(field, (doc, source, lang, n, text)))


def climb(nodes):
    """(root, the siblings of each node from below, with whether they stand on the left)."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for way, i in zip(ways, at, strict=True):
            run = [j for j in (i // 2 * 2, i // 2 * 2 + 1) if j < len(nodes)]
            way.append([(nodes[j], j < i) for j in run if j != i])
        nodes = [H(*nodes[j:j + 2]) for j in range(0, len(nodes), 2)]
        at = [i // 2 for i in at]
    return nodes[0], ways


def brute(data):
    langs = {}
    for r in data:
        langs.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(*r), r))
    names = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: (sorted(langs[x], key=lambda t: t[:3]), *climb([t[2] for t in sorted(langs[x], key=lambda t: t[:3])])) for x in names}
    root, tops = climb([trees[x][1] for x in names])
    out = []
    for x, top in zip(names, tops, strict=True):
        mine, subroot, ways = trees[x]
        for (_, _, h, r), way in zip(mine, ways, strict=True):
            way = way + top
            claim = h
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None:
                claim = leaf(*r[:4], r[4] + 1)
            now = claim
            for level in way:
                now = H(*[s for s, left in level if left], now, *[s for s, left in level if not left])
            out.append((r[0], h, subroot, root, H(*[s for level in way for s, _ in level]), now, now == root))
    return out


def table():
    langs = [None, "", "en", "en", "en", "é", "z", "en"]
    plain = [(doc, text, langs[i % 8], None if i % 5 == 0 else f"s{i % 3}", None if i % 11 == 0 else len(text or "")) for i, (doc, text) in enumerate(rows())]
    return plain + plain[5:9] + [(1000 + i, f"t{i}", "hot", "s", 2) for i in range(70)] + [(2000, "alone", "one", None, 5)]


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("every", [1, 2, 10])
def test_equals_brute_force(spark, every):
    data = table()
    # columns of brute's rows: doc_id, text, lang, source, n_chars
    want = brute(data)
    docs = spark.createDataFrame(data, DOCS).repartition(5)
    made = merkle.build(merkle.document_leaves(docs), "lang", "doc_id", "leaf", every)
    got = [tuple(r) for r in merkle.verify(made, "claim").select(COLUMNS).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {r[6] for r in got} == {True, False}


def test_only_every_so_many_levels_are_stored(spark):
    data = [(i, str(i), "en", "s", 1) for i in range(300)]
    made = merkle.build(merkle.document_leaves(spark.createDataFrame(data, DOCS)), "lang", "doc_id", "leaf", 3)
    assert [level.count() for level in made.levels] == [300, 38, 5, 1] and [level.count() for level in made.top] == [1]


def test_proofs_have_the_siblings(spark):
    data = [(i, str(i), "en", "s", 1) for i in range(11)]
    made = merkle.build(merkle.document_leaves(spark.createDataFrame(data, DOCS)), "lang", "doc_id", "leaf", 2)
    _, ways = climb([leaf(*r) for r in data])
    for r in merkle.verify(made, "leaf", ways=True).collect():
        assert r.verified and H(*r.proof) == r.proof_sha256
        assert r.proof == [sibling for level in ways[r.doc_id] for sibling, _ in level]


def test_empty_table(no_docs):
    made = merkle.build(merkle.document_leaves(no_docs), "lang", "doc_id", "leaf")
    assert made.root is None and merkle.verify(made, "claim").collect() == []
