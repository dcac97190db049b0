import math
import zlib
from collections import Counter

import numpy as np
import pytest

from period_etl.llm import bloom_lm
from tests.llm.conftest import rows, words


def held(doc):
    return zlib.crc32(str("" if doc is None else doc).encode()) % 7 == 2


def brute(data):
    counts = Counter()
    for doc, text in data:
        if not held(doc):
            counts.update([*words(text), None])
    n, v = sum(counts.values()), len(counts)
    return [(doc, held(doc), len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w))
            for doc, text in data for w in [[*words(text), None]]]


@pytest.mark.parametrize("limit", [bloom_lm.MAX_BYTES, 4_000])
def test_base_score(docs, limit):
    """With the vocabulary broadcast, and with a bound so small that it is joined."""
    got = sorted((tuple(r)[:6] for r in bloom_lm.score_documents(docs, max_bytes=limit).collect()), key=lambda r: (str(r[0]), r[2]))
    want = sorted(brute(rows()), key=lambda r: (str(r[0]), r[2]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want])


@pytest.mark.parametrize("limit", [4_000, 40_000])
def test_scores_do_not_depend_on_the_bound(docs, limit):
    """A filter beyond the broadcast's bound keeps its bits for each entry: probed by slice, it gives the same scores."""
    whole, parted = ([(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.score) for r in bloom_lm.score_documents(docs, max_bytes=m).collect()]
                     for m in (bloom_lm.MAX_BYTES, limit))
    assert sorted(x[:5] for x in parted) == sorted(x[:5] for x in whole)
    assert [x[5] for x in sorted(parted)] == pytest.approx([x[5] for x in sorted(whole)], rel=1e-12)


def test_empty_tables(no_docs, spark):
    assert bloom_lm.score_documents(no_docs).collect() == []
    only = spark.createDataFrame([(d, "some words") for d in range(60) if held(d)], "doc_id long, text string")
    assert {(r.n_known, r.train_tokens, r.base_score) for r in bloom_lm.score_documents(only).collect()} == {(0, 0, 0.0)}


def test_model_beats_the_base_on_held_out_text(spark):
    rng = np.random.default_rng(0)
    data = []
    for d in range(300):   # a chain: each word has four words that may follow
        w = [0]
        while len(w) < 150:
            w.append(int((w[-1] * 7 + rng.integers(0, 4) ** 2 + 1) % 500))
        data.append((d, " ".join(f"w{x}" for x in w)))
    out = bloom_lm.score_documents(spark.createDataFrame(data, "doc_id long, text string")).where("held_out").collect()
    assert len(out) > 20
    assert sum(r.score for r in out) > 0.6 * sum(r.base_score for r in out)


def grams(data):
    """Exact counts of a corpus's tokens and bigrams, and its tokens by text; None ends a text and START begins one."""
    texts = [[*words(t), None] for _, t in data]
    return Counter(w for t in texts for w in t), Counter(p for t in texts for p in zip(["START", *t], t, strict=False)), texts


def fitted(spark, data):
    """The broadcast model of a corpus, without held-out texts."""
    docs = spark.createDataFrame(data, "doc_id long, text string").selectExpr("doc_id", "false AS held_out", "text")
    merged = bloom_lm._merged(bloom_lm._counted(bloom_lm._chunked(docs), 8), False).cache()
    return bloom_lm.collected(merged, 8)


def zipf(n_texts, vocabulary=3000):
    rng = np.random.default_rng(5)
    return [(i, " ".join(f"w{x}" for x in np.minimum(rng.zipf(1.3, 200), vocabulary))) for i in range(n_texts)]


def test_probabilities_sum_to_one(spark):
    """Over the vocabulary and an unknown word, after frequent words, rare ones and the start of a text."""
    data = zipf(400)
    count, pair, _ = grams(data)
    model, vocabulary, exact = fitted(spark, data)
    assert len(vocabulary) == len(count) == model.n_words and exact.sum() == sum(count.values())
    unknown = np.append(vocabulary, np.uint64(12345))
    alone = model.counts(unknown, unknown[:0])[0]
    assert alone[-1] == 0 and np.allclose(np.sort(alone[:-1]), np.sort(exact), rtol=0.008)
    by_count = np.argsort(-exact.astype(np.int64))
    places = [*range(10), len(by_count) // 4, len(by_count) // 2, *range(len(by_count) - 40, len(by_count))]
    for v in [np.uint64(bloom_lm.START), np.uint64(999), *vocabulary[by_count[places]]]:
        history = model.counts(np.array([bloom_lm.END if v == bloom_lm.START else v], np.uint64), unknown[:0])[0][0]
        both = model.counts(unknown[:0], bloom_lm.mix(v * bloom_lm._PAIR + unknown))[1]
        p = bloom_lm.probability(alone, both, np.full(len(alone), history), model.n_words, model.mass, model.ghost)
        assert p.sum() == pytest.approx(1, abs=0.02)


@pytest.mark.parametrize("limit", [bloom_lm.MAX_BYTES, 4_000])
def test_score_is_the_models_log_probability(spark, limit):
    """Against the same smoothing with exact counts: at most 0.004 a token apart."""
    data = [(d, t) for d, t in zipf(150)]
    train = [(d, t) for d, t in data if not held(d)]
    count, pair, _ = grams(train)
    n, v = sum(count.values()), len(count)
    got = {r.doc_id: r.score for r in bloom_lm.score_documents(spark.createDataFrame(data, "doc_id long, text string"), max_bytes=limit).collect()}
    for d, t in data:
        want, before, size = 0.0, "START", 0
        for w in [*words(t), None]:
            history = count[None] if before == "START" else count[before]
            alone = (count[w] + 1) / (n + v + 1)
            want += math.log10((pair[before, w] + bloom_lm.MU * alone) / (history + bloom_lm.MU))
            before, size = w, size + 1
        assert abs(got[d] - want) <= 0.004 * size


def test_filter_holds_log_counts():
    rng = np.random.default_rng(1)
    hashes, counts = rng.integers(0, 1 << 63, 20_000).astype(np.uint64), np.concatenate([np.arange(1, 10_001), rng.integers(1, 1 << 40, 10_000)])
    model = bloom_lm.LogFilter(bloom_lm.filter_words(hashes, counts), np.array([0, 0]))
    model.edge = np.array([0, len(model.words)])
    none = np.zeros(len(hashes), np.int64)
    got = bloom_lm.represented(*model.codes(hashes, none))
    assert (got[counts < 128] == counts[counts < 128]).all() and np.abs(got / counts - 1).max() < 0.008
    other = rng.integers(0, 1 << 63, 2_000_000).astype(np.uint64)
    hits = (model.codes(other, np.zeros(len(other), np.int64))[0] > 0).sum()
    assert bloom_lm.false_hits(model.words) < 1e-6 and hits <= 6


def test_false_hits_are_estimated_from_the_bits():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 1 << 63, 1 << 12).astype(np.uint64) | rng.integers(0, 1 << 63, 1 << 12).astype(np.uint64) << np.uint64(1)
    model = bloom_lm.LogFilter(words, np.array([0, len(words)]))
    probes = rng.integers(0, 1 << 63, 3_000_000).astype(np.uint64)
    hits = (model.codes(probes, np.zeros(len(probes), np.int64))[0] > 0).mean()
    assert hits == pytest.approx(bloom_lm.false_hits(words), rel=0.1)


def test_blobs_hold_large_counts():
    h, c = np.arange(5, dtype=np.uint64) << np.uint64(30), np.array([1, 254, 2**40, 255, 256])
    for width in (5, 8):
        back = bloom_lm._unblob(bloom_lm._blob(h, c, width), width)
        assert (back[0] == h).all() and (back[1] == c).all()
