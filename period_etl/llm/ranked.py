"""Ranked lexical search by best-first document intervals over range-maximum tables.

The documents are scanned once: each one's terms that any query holds are kept
with their frequencies, and the numbers that the weights need (documents,
terms, documents of each term) are summed over all of them. Then tasks read
these rows in segments of about ``SEGMENT`` postings. In a segment documents
stand in ascending id order; each term has a posting list with its impact in
each document, and a sparse table that answers where the largest impact of any
range of the list is. A query starts with one interval of all documents. An
interval's bound is the sum of its terms' range maxima. The intervals with the
highest bounds are taken first, ``ROUND`` at a time: each is split at the document
of its largest impact, which is scored, and both sides come back with bounds of
their own. It ends when no bound reaches the k-th best score. Segments of one
task share that score, so later ones end sooner; the best of all tasks are
ranked at the end.

Queries are a set that is asked of all documents: it is taken in blocks of
about ``BLOCK_BYTES`` of text, whose terms and weights are broadcast, so any
number of queries passes. Nothing is left out: results are those of scoring
every document.

Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased, and
told apart by 64-bit hashes. Rows: a null or empty text has no terms and is
not counted as a document. Repeated rows are documents of their own; of equal
scores the smaller doc_id comes first, a null one before all. A query without
terms, or none of them in any document, has no result; repeated queries each
have their own. Queries are told apart by their rows, so repeated item_ids each
get ranks from 1. Columns other than the named ones are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from period_etl.llm import textnp
from period_etl.llm.common import parts, ship, stored
from period_etl.llm.textnp import U64

#: Postings of one segment, about, and documents of one at most.
SEGMENT, SEGMENT_DOCS = 1 << 19, 1 << 14
#: Documents that one searching task reads, about.
PER_TASK = 1 << 16
#: Intervals that one round splits at most.
ROUND = 256
#: Text of one block of queries, about.
BLOCK_BYTES = 4 << 20
_APART = np.ones(256, bool)
for _first, _last in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _APART[_first:_last] = False
_LEAST = np.iinfo(np.int64).min


def terms(column: pa.Array) -> textnp.Words:
    """The terms of each text of a ``strings()`` array."""
    return textnp.words(column, apart=_APART)


def weights(n_docs: int, found: np.ndarray) -> np.ndarray:
    """The weight of each term from the documents that hold it."""
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * found + 1))).astype(np.int64)


class Postings:
    """The posting lists of one segment: list t is [edge[t], edge[t + 1]), with documents ascending in each."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_terms: int, n_docs: int):
        self.n_docs, self.key, self.doc, self.impact = n_docs, term * n_docs + doc, doc, impact
        self.edge = np.searchsorted(term, np.arange(n_terms + 1))
        # best[j][i]: where the largest impact of the 2**j postings from i on is, the first of equal ones
        self.best, size = [np.arange(len(doc))], 1
        while 2 * size <= np.diff(self.edge).max(initial=0):
            low = self.best[-1]
            a, b = low[:-size], low[size:]
            self.best.append(np.where(impact[b] > impact[a], b, a))
            size *= 2
        self.table = np.concatenate(self.best) if len(doc) else np.zeros(0, np.int64)
        self.row = np.cumsum([0, *map(len, self.best)])[:-1]

    def at(self, terms_: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """For each document (rows) and term (columns) the first posting of the term from that document on."""
        return np.searchsorted(self.key, terms_ * self.n_docs + docs[:, None])

    def maxima(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(largest impact, its posting) of each range of postings; an empty one has 0."""
        size = hi - lo
        some = size > 0
        level = np.frexp(np.where(some, size, 1).astype(float))[1] - 1
        start = self.row[level]
        a = self.table[np.where(some, start + lo, 0)]
        b = self.table[np.where(some, start + hi - (1 << level), 0)]
        where = np.where(self.impact[b] > self.impact[a], b, a)
        return np.where(some, self.impact[where], 0), where

    def search(self, query: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the k best documents for a query's term numbers, of those above 0 that reach ``least``."""
        query = query[self.edge[query] < self.edge[query + 1]]
        if not len(query):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        doc, score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        lo, hi = self.edge[query][None], self.edge[query + 1][None]
        top, where = self.maxima(lo, hi)
        bound, need = top.sum(1), max(1, least)
        while len(lo):
            # the highest bounds first; what can't reach the k-th best score any more goes
            if len(lo) > ROUND:
                order = np.argpartition(-bound, ROUND)
                now, later = order[:ROUND], order[ROUND:]
            else:
                now, later = np.arange(len(lo)), np.zeros(0, np.int64)
            each = np.argmax(top[now], 1)
            split = self.doc[where[now, each]]
            middle = self.at(query, split)
            inside = middle < hi[now]
            mine = inside & (self.doc[np.minimum(middle, len(self.doc) - 1)] == split[:, None])
            doc, score = np.append(doc, split), np.append(score, np.where(mine, self.impact[np.minimum(middle, len(self.doc) - 1)], 0).sum(1))
            if len(doc) > k:
                keep = np.lexsort((doc, -score))[:k]
                doc, score = doc[keep], score[keep]
            if len(doc) == k:
                need = max(need, int(score[-1]))
            left, right = (lo[now], middle), (middle + mine, hi[now])
            new_lo, new_hi = np.concatenate([left[0], right[0]]), np.concatenate([left[1], right[1]])
            new_top, new_where = self.maxima(new_lo, new_hi)
            new_bound = new_top.sum(1)
            held, come = later[bound[later] >= need], np.flatnonzero(new_bound >= need)
            lo, hi = np.concatenate([lo[held], new_lo[come]]), np.concatenate([hi[held], new_hi[come]])
            top, where = np.concatenate([top[held], new_top[come]]), np.concatenate([where[held], new_where[come]])
            bound = np.concatenate([bound[held], new_bound[come]])
        keep = np.flatnonzero(score >= max(1, least))
        keep = keep[np.lexsort((doc[keep], -score[keep]))]
        return doc[keep], score[keep]


def _scanned(docs: DataFrame, known: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, term, tf) of each document with terms: how many, and which of ``known`` how often."""
    table = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        for batch in batches:
            text = textnp.strings(batch.column(1))
            for lo, hi in textnp.chunks(text):
                w = terms(text.slice(lo, hi - lo))
                hashes, doc = w.hashes(), w.doc
                at = np.minimum(np.searchsorted(table.value, hashes), len(table.value) - 1)
                hit = table.value[at] == hashes
                pair, tf = np.unique(doc[hit] * len(table.value) + at[hit], return_counts=True)
                some = np.flatnonzero(w.counts)
                owner = pair // len(table.value)
                edge = np.append(np.searchsorted(owner, some), len(owner)).astype(np.int32)
                yield pa.record_batch([
                    batch.column(0).slice(lo, hi - lo).take(pa.array(some)), pa.array(w.counts[some], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(edge), pa.array((pair % len(table.value)).astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(edge), pa.array(tf.astype(np.int32)))], names=["doc_id", "n", "term", "tf"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n long, term array<int>, tf array<int>")


def _segments(batches, size: int, most: int):
    """The batches joined to segments of at most about ``size`` postings and ``most`` documents."""
    held, postings, rows = [], 0, 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            part = batch.slice(lo, 512)
            more = len(part.column("term").flatten())
            if held and (postings + more > size or rows + part.num_rows > most):
                yield pa.Table.from_batches(held)
                held, postings, rows = [], 0, 0
            held.append(part)
            postings, rows = postings + more, rows + part.num_rows
    if held:
        yield pa.Table.from_batches(held)


def _block(spark: SparkSession, docs: DataFrame, queries: list[tuple[int, np.ndarray]], k: int, id_col: str, text_col: str,
           size: int, most: int) -> DataFrame | None:
    """(q, doc_id, score): the k best documents of each task for each query (number, term hashes) of a block."""
    known = np.unique(np.concatenate([h for _, h in queries])) if queries else np.zeros(0, U64)
    if not len(known):
        return None
    scanned = stored(_scanned(docs, known, id_col, text_col), "ranked-scan")
    n_docs, n_terms = scanned.agg(F.count("*"), F.sum("n")).first()
    found = np.zeros(len(known), np.int64)
    for r in scanned.select(F.explode("term").alias("t")).groupBy("t").count().toLocalIterator():
        found[r.t] = r["count"]
    asked = [(q, np.searchsorted(known, np.unique(h))) for q, h in queries]
    shared = spark.sparkContext.broadcast((weights(n_docs, found), asked))

    def run(batches):
        weight, ask = shared.value
        best = {q: (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for q, _ in ask}
        for table in _segments(batches, size, most):
            ids = table.column("doc_id").combine_chunks()
            named, ids = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(_LEAST).to_numpy(zero_copy_only=False)
            order = np.lexsort((ids, named))
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            lists = table.column("term").combine_chunks()
            doc = np.repeat(place, np.diff(lists.offsets.to_numpy()))
            term, tf = lists.flatten().to_numpy().astype(np.int64), table.column("tf").combine_chunks().flatten().to_numpy().astype(np.int64)
            n = np.empty(len(order), np.int64)
            n[place] = table.column("n").to_numpy()
            impact = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * (10 + 90 * n[doc] * n_docs // n_terms)))
            by = np.lexsort((doc, term))
            lists = Postings(term[by], doc[by], impact[by], len(weight), len(order))
            for q, query in ask:
                key, real, score = best[q]
                new, points = lists.search(query, k, int(score[-1]) if len(score) == k else 0)
                if len(new):
                    key, real, score = np.append(key, ids[order][new]), np.append(real, named[order][new]), np.append(score, points)
                    keep = np.lexsort((key, real, -score))[:k]
                    best[q] = key[keep], real[keep], score[keep]
        for q, (key, real, score) in best.items():
            if len(key):
                yield pa.record_batch([pa.array(np.full(len(key), q)), pa.array(key, mask=~real), pa.array(score)], names=["q", "doc_id", "score"])

    # a task's share stays the same however small the stored rows are: their files hold more documents than those of the texts
    return scanned.repartition(parts(spark, n_docs // PER_TASK)).mapInArrow(run, "q long, doc_id long, score long")


def ranked_search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  query_col: str = "text", block_bytes: int = BLOCK_BYTES, segment: int = SEGMENT, segment_docs: int = SEGMENT_DOCS) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of ``queries`` the k documents of the highest scores above 0."""
    spark = docs.sparkSession
    ship(spark)
    asked = stored(queries.select(F.col(item_col).alias("item"), F.col(query_col).alias("text")).withColumn("q", F.monotonically_increasing_id()), "ranked-queries")
    blocks = max(1, -(-(asked.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0) // block_bytes))
    found = None
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == b).select("q", "text").toArrow()
        held = terms(textnp.strings(block.column("text")))
        each = np.split(held.hashes(), held.first[1:-1]) if len(held) else []
        some = _block(spark, docs, list(zip(block.column("q").to_pylist(), each, strict=True)), k, id_col, text_col, segment, segment_docs)
        if some is not None:
            some = stored(some, "ranked-best")
            found = some if found is None else found.unionByName(some)
    if found is None:
        found = spark.createDataFrame([], "q long, doc_id long, score long")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "doc_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(asked.select("q", F.col("item").alias(item_col)), "q").select(item_col, "rank", "doc_id", "score")
