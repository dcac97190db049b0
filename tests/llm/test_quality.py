import itertools
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from period_etl.llm import quality, textnp
from tests.llm.conftest import prose, rows


def brute(text):
    text = text or ""
    w = [x.decode() for x in text.encode().split()]
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    windows, inside = Counter(zip(w, w[1:], w[2:])), [False] * len(w)
    for i in range(len(w) - 2):
        if windows[tuple(w[i:i + 3])] > 1:
            inside[i:i + 3] = [True] * 3
    n, rep = len(w), sum(inside)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, rep, n < 50 or 100 * rep > 50 * n


def junk(seed):
    return " | ".join(prose(seed, 150).split()) + "\n" + " ".join(w + "%%%" for w in prose(seed + 1, 80).split())


@pytest.fixture()
def labelled(spark):
    data = [(1000 + i, prose(1000 + i, 150), 1) for i in range(40)] + [(2000 + i, junk(2000 + i), 0) for i in range(20)]
    docs = spark.createDataFrame([(d, t) for d, t, _ in data], "doc_id long, text string")
    return docs, spark.createDataFrame([(d, q) for d, _, q in data] + [(None, 1), (1, None), (999_999, 0)], "doc_id long, quality int")


def test_counts_equal_brute_force(docs, no_docs):
    field = quality.LineField.empty()
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in quality.quality_rules(docs, field).collect()), key=str)
    assert got == sorted(((d, *brute(t)) for d, t in rows()), key=str)
    assert quality.quality_rules(no_docs, field).collect() == []


def test_held_out_documents_are_told_apart(spark, labelled):
    field = quality.fit_line_field(*labelled)
    unseen = [(i, prose(5000 + i, 150)) for i in range(30)] + [(100 + i, junk(6000 + i)) for i in range(30)]
    unseen += [(200, prose(1, 100) + "\n" + junk(7)), (201, prose(1, 900) + "\n| a | b |\n" + prose(2, 900))]
    frame = spark.createDataFrame(unseen, "doc_id long, text string")
    kept = {r.doc_id for r in quality.quality_rules(frame, field).where("kept").collect()}
    assert kept == {*range(30), 201}
    assert {r.doc_id for r in quality.keep_quality(frame, field).collect()} == kept


def table_line(seed):
    return " | ".join(prose(seed, 12).split())


def test_lines_of_one_document_differ(spark, labelled):
    """Bad documents that hold prose too: their lines get labels of their own, in training and after it."""
    docs, labels = labelled
    mixed = [(3000 + i, "\n".join([" ".join(prose(3000 + i, 40).split())] + [table_line(9000 + 20 * i + j) for j in range(12)]), 0) for i in range(20)]
    docs = docs.unionByName(spark.createDataFrame([(d, t) for d, t, _ in mixed], "doc_id long, text string"))
    labels = labels.unionByName(spark.createDataFrame([(d, q) for d, _, q in mixed], "doc_id long, quality int"))
    field = quality.fit_line_field(docs, labels)
    unseen = []
    for i, (n_prose, n_table) in enumerate([(6, 2), (4, 4), (2, 6), (5, 3)] * 5):   # lines of about 12 words each
        body = [" ".join(prose(7000 + 10 * i + j, 12).split()) for j in range(n_prose)]
        unseen.append((i, "\n".join(body + [table_line(8000 + 10 * i + j) for j in range(n_table)]), n_prose, n_table))
    frame = spark.createDataFrame([r[:2] for r in unseen], "doc_id long, text string")
    got = {r.doc_id: r for r in quality.quality_rules(frame, field).collect()}
    marked = quality.label_lines(frame, field).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("begin", "content"))).alias("lines")).collect()
    right = sum([x.content for x in r.lines] == [True] * unseen[r.doc_id][2] + [False] * unseen[r.doc_id][3] for r in marked)
    assert right >= 18
    shares = {i: r.content_words / r.n_words for i, r in got.items()}
    assert all(0 < s < 1 for s in shares.values())
    assert any(got[i].kept for i in got) and any(not got[i].kept and not got[i].base_failed for i in got)
    assert all(got[i].kept == (100 * got[i].content_words >= 60 * got[i].n_words) for i in got if not got[i].base_failed)


def test_without_labels_the_counts_decide(docs, spark, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    for d, labels in ((docs, none), (no_docs, none)):
        field = quality.fit_line_field(d, labels)
        assert all(r.kept != r.base_failed for r in quality.quality_rules(d, field).collect())
    left = quality.keep_quality(docs, quality.LineField.empty())
    assert left.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in left.collect()) == sorted((str(d), t) for d, t in rows() if not brute(t)[-1])


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(3)
    for _ in range(40):
        sizes = rng.integers(0, 7, 4)
        first = np.concatenate([[0], np.cumsum(sizes)])
        features = rng.normal(size=(first[-1], quality.N_FEATURES))
        field = quality.LineField(np.zeros(quality.N_FEATURES), np.ones(quality.N_FEATURES), rng.normal(size=quality.N_FEATURES), rng.normal(size=(2, 2)) * 2, rng.normal(size=2))
        got, score = field.decode(features, first), field.scores(features)
        for a, b in itertools.pairwise(first):
            def value(path, a=a, b=b):
                return sum(score[a + i, p] for i, p in enumerate(path)) + (field.start[path[0]] if path else 0) + sum(field.move[p, q] for p, q in itertools.pairwise(path))
            assert value(tuple(got[a:b])) == pytest.approx(max(value(p) for p in itertools.product((0, 1), repeat=b - a)))


def test_line_spans(docs):
    texts = [t for _, t in rows()]
    found = quality.lines(textnp.strings(pa.array(texts)))
    for d, a, b, n in zip(found.doc, *found.span, found.words, strict=True):
        line = texts[d].encode()[a:b]
        assert b"\n" not in line and len(line.split()) == n > 0
    assert found.words.sum() == sum(brute(t)[0] for t in texts)
    assert quality.label_lines(docs, quality.LineField.empty()).where("content").count() == len(found.words)
