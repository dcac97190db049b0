"""Quality rules: fixed counts, and a linear-chain conditional random field that marks lines as content or boilerplate.

A document's lines (split at \\n) that hold a word form a sequence. Viterbi
decoding labels each as content (1) or boilerplate (0); the document is kept
if the counts pass and lines of content hold ``MIN_CONTENT`` percent of its
words or more. The field's weights are fitted on a sample of labelled
documents: the MAX_DOCS of them with the least hash of their id. Their lines'
labels are latent. At first the lines of good documents are content but for
those that repeat an earlier line or are rich in symbols, and those of bad ones
boilerplate. Then in turn the field is fitted and the lines of bad documents
take the label that their features speak for, the most content-like ones up to
what a bad document may hold of content, until no label changes. So the chain
learns documents that mix both. Everything else covers all rows.

Rows: a null text is an empty text; it has no words and fails. A labelled
document without a text, or a label without a document, is not used; of
several labels of a doc_id the least counts. Without labelled documents all
lines are content and the counts alone decide. Equal and repeated rows get
equal results; columns other than the two named are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from period_etl.llm import textnp
from period_etl.llm.common import ship

#: Labelled documents that the weights are fitted on, at most.
MAX_DOCS = 2000
MIN_CONTENT = 60
N_FEATURES = 10
ROUNDS, RATE, DECAY = 100, 0.15, 1e-4
#: A line of a good document with more symbols a character than this is boilerplate.
SYMBOL_SHARE = 0.05
#: Times that the latent labels are taken anew, at most.
TURNS = 4

_SYMBOL, _POINT, _DIGIT = (np.zeros(256, np.int32) for _ in range(3))
_SYMBOL[list(b"#*$%&|<>")] = 1
_POINT[list(b"!?;:=_~^{}[]()/\\@+")] = 1
_DIGIT[list(b"0123456789")] = 1
_HEAD = (np.arange(256) & 0xC0 != 0x80).astype(np.int32)  # bytes that begin a code point
_HEAD[[9, 10, 11, 12, 13, 32]] = 0
_UPPER, _LETTER = np.zeros(256, np.int32), np.zeros(256, np.int32)
_UPPER[65:91] = 1
_LETTER[65:91] = _LETTER[97:123] = _LETTER[0xC2:0xF5] = 1


@dataclass
class Lines:
    """The lines with words of some texts, their features, and the counts of the texts."""

    doc: np.ndarray
    words: np.ndarray
    features: np.ndarray
    counts: dict[str, np.ndarray]
    span: tuple[np.ndarray, np.ndarray]  # of each line, in bytes of its text

    @property
    def first(self) -> np.ndarray:
        return np.searchsorted(self.doc, np.arange(len(self.counts["n_words"]) + 1))


def lines(column: pa.Array) -> Lines:
    """The lines of each text of a ``textnp.strings()`` array."""
    w = textnp.words(column, fold=False)
    n, buf = len(w), w.buf
    cut = np.unique(np.concatenate([w.edge, np.flatnonzero(buf == 10) + 1]))
    begin, end = cut[:-1], cut[1:].copy()
    end[buf[end - 1] == 10] -= 1                    # a line goes without its \\n
    line_of = np.searchsorted(begin, w.start, "right") - 1
    size = np.bincount(line_of, minlength=len(begin))
    keep = np.flatnonzero(size)
    begin, end, size = begin[keep], end[keep], size[keep]
    doc = np.searchsorted(w.edge, begin, "right") - 1
    hashes = w.hashes()

    def summed(table, at=None):
        total = np.concatenate([[0], np.cumsum(table[buf] if at is None else at, dtype=np.int64)])
        return total

    def each(total):
        return total[end] - total[begin]

    symbol, heads, letters = summed(_SYMBOL), summed(_HEAD), summed(_LETTER)
    upper = _UPPER[buf]
    upper[:-1] += (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E)
    # words like the one before them or the one before that, and words that end in a symbol
    same = np.zeros(len(hashes), bool)
    number = np.repeat(np.arange(len(size)), size)
    for back in (1, 2):
        same[back:] |= (hashes[back:] == hashes[:-back]) & (number[back:] == number[:-back])
    edge = np.concatenate([[0], np.cumsum(size)])
    per = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[edge])
    ends = _SYMBOL[buf[w.end - 1]] if len(hashes) else np.zeros(0, np.int32)

    line_hash = w.span_hashes(begin, end)
    order = np.lexsort((np.arange(len(line_hash)), line_hash, doc))
    again = np.zeros(len(line_hash), bool)
    again[order[1:]] = (line_hash[order[1:]] == line_hash[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])

    # words of 3-word windows that the text has twice
    word_doc, covered = w.doc, np.zeros(len(hashes), bool)
    if len(hashes) > 2:
        whole = np.flatnonzero(word_doc[2:] == word_doc[:-2])
        window = textnp.mix(textnp.mix(hashes[whole] * textnp._K + hashes[whole + 1]) * textnp._K + hashes[whole + 2])
        order = np.lexsort((window, word_doc[whole]))
        equal = (window[order[1:]] == window[order[:-1]]) & (word_doc[whole[order[1:]]] == word_doc[whole[order[:-1]]])
        twice = np.zeros(len(whole), bool)
        twice[order[1:]] |= equal
        twice[order[:-1]] |= equal
        for j in range(3):
            covered[whole[twice] + j] = True

    chars = np.maximum(each(heads), 1)
    features = np.stack([
        np.ones(len(size)), np.log1p(size) / 4, each(summed(None, upper)) / np.maximum(each(letters), 1), each(symbol) / chars,
        np.minimum(each(summed(_POINT)) / size, 3), each(summed(_DIGIT)) / chars, per(same) / size, chars / size / 10,
        per(ends) / size, again.astype(float)], 1) if len(size) else np.zeros((0, N_FEATURES))
    text_sum = lambda total: total[w.edge[1:]] - total[w.edge[:-1]]
    counts = {
        "n_words": w.counts, "word_chars": text_sum(heads), "n_symbols": text_sum(symbol),
        "n_dup_lines": np.bincount(doc, again, n).astype(np.int64), "n_repeat_words": np.bincount(word_doc, covered, n).astype(np.int64)}
    return Lines(doc, size, features, counts, (begin - w.edge[doc], end - w.edge[doc]))


@dataclass
class LineField:
    """A linear-chain conditional random field over two labels, 1 content and 0 boilerplate."""

    mean: np.ndarray
    scale: np.ndarray
    emit: np.ndarray   # a label's score is +-(features @ emit) / 2
    move: np.ndarray   # move[a, b]: score of b after a
    start: np.ndarray

    @classmethod
    def empty(cls) -> LineField:
        emit = np.zeros(N_FEATURES)
        emit[0] = 10
        return cls(np.zeros(N_FEATURES), np.ones(N_FEATURES), emit, np.zeros((2, 2)), np.zeros(2))

    def scores(self, features: np.ndarray) -> np.ndarray:
        half = ((features - self.mean) / self.scale) @ self.emit / 2
        return np.stack([-half, half], 1)

    def decode(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Viterbi labels; sequence i has the rows first[i]:first[i + 1]. Of equal paths the one with content wins."""
        score, out = self.scores(features), np.zeros(len(features), np.int8)
        size = np.diff(first)
        order = np.argsort(-size, kind="stable")
        begin, size = first[:-1][order], size[order]
        if not len(features):
            return out
        back = np.zeros((len(features), 2), np.int8)
        best = np.zeros((len(order), 2))
        for t in range(int(size[0])):
            live = int(np.searchsorted(-size, -t, "left"))  # sequences with more than t rows
            at = begin[:live] + t
            if t:
                paths = best[:live, :, None] + self.move
                pick = (paths[:, 1] >= paths[:, 0]).astype(np.int8)
                back[at] = pick
                best[:live] = np.where(pick == 1, paths[:, 1], paths[:, 0]) + score[at]
            else:
                best[:live] = self.start + score[at]
        label = (best[:, 1] >= best[:, 0]).astype(np.int8)
        for t in range(int(size[0]) - 1, -1, -1):
            live = int(np.searchsorted(-size, -t, "left"))
            at = begin[:live] + t
            out[at] = label[:live]
            label[:live] = back[at, label[:live]]
        return out

    @classmethod
    def fit(cls, features: np.ndarray, first: np.ndarray, labels: np.ndarray) -> LineField:
        """Greatest regularised likelihood of the row labels by Adam over all sequences at once."""
        if not len(features):
            return cls.empty()
        mean, scale = features.mean(0), features.std(0)
        mean[0], scale[scale < 1e-6] = 0, 1
        model = cls(mean, scale, np.zeros(N_FEATURES), np.zeros((2, 2)), np.zeros(2))
        x = (features - mean) / scale
        size = np.diff(first)
        order = np.argsort(-size, kind="stable")
        order = order[size[order] > 0]
        begin, size = first[:-1][order], size[order]
        live = [int(np.searchsorted(-size, -t, "left")) for t in range(int(size[0]))]
        y, opens = labels.astype(int), begin
        inner = np.ones(len(y), bool)
        inner[opens] = False
        seen_move = np.zeros((2, 2))
        np.add.at(seen_move, (y[:-1][inner[1:]], y[1:][inner[1:]]), 1)
        seen_start, n = np.bincount(y[opens], minlength=2), len(y)
        theta, m, v = np.zeros(N_FEATURES + 6), 0.0, 0.0
        for step in range(1, ROUNDS + 1):
            model.emit, model.move, model.start = theta[:N_FEATURES], theta[N_FEATURES:-2].reshape(2, 2), theta[-2:]
            score = model.scores(features)
            ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
            ahead[opens] = model.start + score[opens]
            for t in range(1, len(live)):
                at = begin[:live[t]] + t
                ahead[at] = np.logaddexp(ahead[at - 1, 0, None] + model.move[0], ahead[at - 1, 1, None] + model.move[1]) + score[at]
            for t in range(len(live) - 1, 0, -1):
                at = begin[:live[t]] + t
                on = behind[at] + score[at]
                behind[at - 1] = np.logaddexp(on[:, 0, None] + model.move[:, 0], on[:, 1, None] + model.move[:, 1])
            total = np.logaddexp(*(ahead + behind).T)
            share = np.exp(ahead[:, 1] + behind[:, 1] - total)
            to = np.flatnonzero(inner)
            pair = ahead[to - 1][:, :, None] + model.move + (score[to] + behind[to])[:, None, :] - total[to][:, None, None]
            start = np.array([(1 - share[opens]).sum(), share[opens].sum()])
            slope = np.concatenate([(y - share) @ x, (seen_move - np.exp(pair).sum(0)).ravel(), seen_start - start]) / n - DECAY * theta
            m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
            theta = theta + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        model.emit, model.move, model.start = theta[:N_FEATURES], theta[N_FEATURES:-2].reshape(2, 2), theta[-2:]
        return model


def line_labels(features: np.ndarray, first: np.ndarray, good: np.ndarray) -> np.ndarray:
    """The latent label of each line of documents that are good or bad as a whole."""
    doc, words = np.repeat(np.arange(len(good)), np.diff(first)), np.expm1(features[:, 1] * 4)
    room = np.bincount(doc, words, len(good)) * (100 - MIN_CONTENT) / 100
    fair = good[doc] & (features[:, 9] == 0) & (features[:, 3] <= SYMBOL_SHARE)
    label = fair.astype(int)
    for _ in range(TURNS):
        score = LineField.fit(features, first, label).scores(features)
        lean = score[:, 1] - score[:, 0]
        order = np.lexsort((-lean, doc))
        total = np.concatenate([[0], np.cumsum(words[order])])
        within = np.empty(len(doc), bool)
        within[order] = total[1:] - total[first[:-1]][doc[order]] <= room[doc[order]]
        new = np.where(good[doc], fair, (lean > 0) & within).astype(int)
        if (new == label).all():
            break
        label = new
    return label


def fit_line_field(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                   max_docs: int = MAX_DOCS) -> LineField:
    """Fit the field on at most ``max_docs`` labelled documents; only their lines' features (80 bytes a line) come to the driver."""
    ship(docs.sparkSession)
    picked = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
              .groupBy("id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(max_docs))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text is not null")

    def run(batches):
        for batch in batches:
            for lo, hi in textnp.chunks(text := textnp.strings(batch.column("text"))):
                found = lines(text.slice(lo, hi - lo))
                first = found.first
                data = [found.features[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.record_batch([batch.column("id").slice(lo, hi - lo), batch.column("label").slice(lo, hi - lo), pa.array(data, pa.binary())],
                                      names=["id", "label", "features"])

    rows = texts.join(F.broadcast(picked), "id").mapInArrow(run, "id long, label int, features binary").collect()
    rows = sorted({(r.id, r.label, bytes(r.features)) for r in rows})
    each = [np.frombuffer(r[2]).reshape(-1, N_FEATURES) for r in rows]
    first = np.concatenate([[0], np.cumsum([len(e) for e in each])]).astype(np.int64)
    flat = np.concatenate([*each, np.zeros((0, N_FEATURES))])
    return LineField.fit(flat, first, line_labels(flat, first, np.array([r[1] > 0 for r in rows], bool)))


def _verdicts(found: Lines, field: LineField, min_content: int) -> dict[str, np.ndarray]:
    label = field.decode(found.features, found.first)
    n = found.counts["n_words"]
    content = np.bincount(found.doc, found.words * label, len(n)).astype(np.int64)
    failed = (n < 50) | (100 * found.counts["n_repeat_words"] > 50 * n)
    return {**found.counts, "content_words": content, "base_failed": failed, "kept": ~failed & (100 * content >= min_content * n)}


def quality_rules(docs: DataFrame, field: LineField, id_col: str = "doc_id", text_col: str = "text", min_content: int = MIN_CONTENT) -> DataFrame:
    """(doc_id, the counts, content_words, base_failed, kept) for each row."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for lo, hi in textnp.chunks(text := textnp.strings(batch.column(1))):
                out = _verdicts(lines(text.slice(lo, hi - lo)), field, min_content)
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), *map(pa.array, out.values())], names=["doc_id", *out])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).mapInArrow(
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, content_words long, "
        "base_failed boolean, kept boolean")


def keep_quality(docs: DataFrame, field: LineField, text_col: str = "text", min_content: int = MIN_CONTENT) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            for lo, hi in textnp.chunks(text := textnp.strings(batch.column(at))):
                yield batch.slice(lo, hi - lo).filter(pa.array(_verdicts(lines(text.slice(lo, hi - lo)), field, min_content)["kept"]))

    return docs.mapInArrow(run, docs.schema)


def label_lines(docs: DataFrame, field: LineField, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, begin, end, n_words, content): each line with a word, as bytes begin:end of its text in UTF-8."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for lo, hi in textnp.chunks(text := textnp.strings(batch.column(1))):
                found = lines(text.slice(lo, hi - lo))
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo).take(pa.array(found.doc)), pa.array(found.span[0]), pa.array(found.span[1]),
                                       pa.array(found.words), pa.array(field.decode(found.features, found.first) == 1)],
                                      names=["doc_id", "begin", "end", "n_words", "content"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).mapInArrow(run, "doc_id long, begin long, end long, n_words long, content boolean")
