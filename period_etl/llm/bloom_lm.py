"""Language-model scoring with a log-frequency Bloom filter.

Words are lower-cased (A-Z) runs without ASCII white space; each text ends
with one end token. The corpus's unigrams and bigrams (a start token stands
before each text) are counted over all training documents. A count c is stored
as its logarithm in the filter: the n-gram is put in once for each level 1 to
q = 1 + floor(log2 c), and once for each bit that is set in the six binary
digits of c after the first. Scoring probes levels 1, 2, ... until one is
missing, then the digits: counts up to 127 come back exactly, larger ones
within 0.8 percent.

The probability of w after v is (count(v w) + MU * p(w)) / (count(v) + ghost + MU)
with p(w) = (count(w) + 1) / (N + V + 1), all counts from the filter, N their
sum over the V training words. A bigram is probed only if both words are found, and
``ghost`` is the mass that false hits are expected to add over the vocabulary,
V times the filter's false hit rate, which its bits give exactly. So the
probabilities of all words and the unknown one sum to 1 for every v, within the
quantisation (1 percent) and the chance of the hits. A word v that is not found leaves p(w).

The filter is an array of 64-bit words; an entry sets HASHES bits in each of WORDS of
them, with BITS bits for each entry whatever the corpus's size: a probe that
should miss hits about once in 5 million.

Texts are stored in chunks, compressed. Tasks count the n-grams of a chunk and
send them to hash slices; each slice sums its n-grams and builds its part of
the filter. Up to ``max_bytes`` the filter and the exact vocabulary of the base
score, together, are broadcast. A larger filter stays in its slices: each slice probes
the n-grams that the chunks sent it and answers with levels, digits and the
words' exact counts, and a chunk's answers are joined with it by a shuffle. Both
ways give the same scores, and no table grows in a worker or the driver beyond the bound.

Words are told apart by 64-bit hashes, bigrams by 40 bits within their slice.
Rows: a null text is an empty text (one end token). A null doc_id's hash is
that of the empty string. Repeated rows each count and each get a row. Without
training documents all counts are 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from period_etl.llm import textnp
from period_etl.llm.common import ship, stored
from period_etl.llm.textnp import U64, mix

BITS, WORDS, HASHES, DIGITS = 36, 4, 6, 6
#: Bytes of the filter and the vocabulary that are broadcast at most, together.
MAX_BYTES = 64 << 20
MU = 4.0
#: N-grams that one slice of the counts holds, about.
PER_SLICE = 500_000
#: Text of a chunk, about.
CHUNK_BYTES = 4 << 20
START, END = mix(np.array([0x5354415254], U64))[0], mix(np.array([0x454E44], U64))[0]
_STEP, _ALL = 0x9E3779B97F4A7C15, (1 << 64) - 1
_PAIR = U64(0xD6E8FEB86659FD93)
_DIGIT = 64      # salts of the digits; those of the levels are below
_OUT = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
_KINDS = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes with an end token after each text, text index, hashes of the bigrams that end there)."""
    w = textnp.words(column)
    n = len(w)
    out = np.full(len(w.start) + n, END)
    doc = np.repeat(np.arange(n), w.counts + 1)
    out[np.arange(len(w.start)) + w.doc] = w.hashes()
    before = np.concatenate([[START], out[:-1]])[:len(out)]
    before[np.searchsorted(doc, np.arange(n))] = START
    return out, doc, mix(before * _PAIR + out)


def short(pairs: np.ndarray) -> np.ndarray:
    """The 40 bits that tell the bigrams of a slice apart."""
    return pairs >> U64(24)


def keys(pairs40: np.ndarray) -> np.ndarray:
    """What stands for a bigram in the filter."""
    return mix(pairs40 * _PAIR + U64(1))


# --- counts as logarithms ----------------------------------------------------

def quantised(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(levels, digits) of counts; 0 has no level."""
    level = np.frexp(counts.astype(float))[1].astype(np.int64)
    return level, np.where(level > 0, (counts << DIGITS >> np.maximum(level - 1, 0)) & (1 << DIGITS) - 1, 0)


def represented(level: np.ndarray, digits: np.ndarray) -> np.ndarray:
    """The count that a level and its digits stand for."""
    cut = np.where(level - 1 > DIGITS, 0.5, 0.0)   # digits were cut off: the middle of what they may have been
    return np.where(level > 0, np.exp2(level - 1.0) * (1 + (digits + cut) / (1 << DIGITS)), 0.0)


def _entries(counts: np.ndarray) -> int:
    level, digits = quantised(counts)
    return int(level.sum() + np.bitwise_count(digits).sum())


def _places(hashes: np.ndarray, salt: int, nth: int, size: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """(word, mask) of each hash's ``nth`` place for a level or digit."""
    h = mix(hashes + U64((salt * WORDS + nth + 1) * _STEP & _ALL))
    mask = np.zeros(len(h), U64)
    for i in range(HASHES):
        mask |= U64(1) << (h >> U64(6 * i) & U64(63))
    # the word comes from other bits than the mask's 36
    return ((mix(h) >> U64(32)) * np.asarray(size).astype(U64) >> U64(32)).astype(np.int64), mask


def filter_words(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The filter of n-grams with counts above 0."""
    words = np.zeros(max(1, int(_entries(counts) * BITS / 64)) if len(hashes) else 0, U64)
    level, digits = quantised(counts)
    some = [(q, level >= q) for q in range(1, int(level.max(initial=0)) + 1)] + [(_DIGIT + b, digits >> b & 1 == 1) for b in range(DIGITS)]
    for salt, has in some:
        mine = hashes[has]
        for nth in range(WORDS if len(mine) else 0):
            np.bitwise_or.at(words, *_places(mine, salt, nth, len(words)))
    return words


def false_hits(words: np.ndarray) -> float:
    """The chance that a probe for what was never put in hits."""
    return float(np.mean((np.bitwise_count(words) / 64.0) ** HASHES) ** WORDS) if len(words) else 0.0


@dataclass
class LogFilter:
    """A filter in slices: the n-grams of slice hash % slices are in words[edge[slice]:edge[slice + 1]].

    ``mass`` is the sum of the words' counts as the filter gives them, ``ghost`` the expected false hits over the vocabulary.
    """

    words: np.ndarray
    edge: np.ndarray
    n_words: int = 0
    mass: float = 0.0
    ghost: float = 0.0

    def codes(self, hashes: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(levels, digits) of each hash of the given slices, by one probe after the other."""
        level, digits = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        base, size = self.edge[part], self.edge[part + 1] - self.edge[part]

        def found(live, salt):
            for nth in range(WORDS):
                at, mask = _places(hashes[live], salt, nth, size[live])
                live = live[self.words[base[live] + at] & mask == mask]
            return live

        live, salt = np.flatnonzero(size > 0), 1
        while len(live):
            live = found(live, salt)
            level[live] = salt
            salt += 1
        for b in range(DIGITS):   # a count below 2**DIGITS has fewer digits
            digits[found(np.flatnonzero(level > DIGITS - b), _DIGIT + b)] |= 1 << b
        return level, digits

    def counts(self, words: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The counts of words and bigrams, each distinct one probed once."""
        n = U64(len(self.edge) - 1)
        out = []
        for hashes, key in ((words, lambda h: h), (pairs, lambda h: keys(short(h)))):
            one, at = np.unique(hashes, return_inverse=True)
            out.append(represented(*self.codes(key(one), (one % n).astype(np.int64)))[at])
        return out[0], out[1]

    def log_probability(self, words: np.ndarray, doc: np.ndarray, pairs: np.ndarray, n: int) -> np.ndarray:
        return _smoothed(*self.counts(words, pairs), doc, n, self.n_words, self.mass, self.ghost)


def _smoothed(count: np.ndarray, both: np.ndarray, doc: np.ndarray, n: int, n_words: int, mass: float, ghost: float) -> np.ndarray:
    """The log10 probability of each of ``n`` texts from the counts of its tokens and of the bigrams that end there."""
    opens = np.ones(len(count), bool)
    opens[1:] = doc[1:] != doc[:-1]
    history = np.empty(len(count))
    history[1:] = count[:-1]
    history[opens] = count[-1:]   # a text begins as often as one ends, and the last token is an end
    return np.bincount(doc, np.log10(probability(count, both, history, n_words, mass, ghost)), n)


def probability(count: np.ndarray, both: np.ndarray, history: np.ndarray, n_words: int, mass: float, ghost: float) -> np.ndarray:
    """p(w | v) from the counts of w, of v w and of v."""
    alone = (count + 1) / (mass + n_words + 1)
    probed = np.where((count > 0) & (history > 0), np.minimum(both, np.minimum(history, count)), 0)
    return (probed + MU * alone) / (history + np.where(history > 0, ghost, 0) + MU)


# --- blobs -------------------------------------------------------------------

def _pack(counts: np.ndarray) -> bytes:
    """Counts as bytes, the few above 254 as 64-bit integers behind them."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return small.tobytes() + counts[small == 255].astype("<i8").tobytes()


def _unpack(data: bytes, n: int, at: int = 0) -> np.ndarray:
    counts = np.frombuffer(data, np.uint8, n, at).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<i8", -1, at + n)
    return counts


def _blob(hashes: np.ndarray, counts: np.ndarray, width: int) -> bytes:
    """n-grams of ``width`` bytes each, then their counts."""
    plain = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
    return len(hashes).to_bytes(8, "little") + plain + _pack(counts)


def _unblob(data: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8, n * width, 8).reshape(n, width)
    return wide.view("<u8").reshape(-1).astype(U64, copy=False), _unpack(data, n, 8 + n * width)


def _sum(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes, the sum of each one's counts, their place at each given hash)."""
    if not len(hashes):
        return hashes, counts, np.zeros(0, np.int64)
    order = np.argsort(hashes)
    new = np.concatenate([[True], np.diff(hashes[order]) != 0])
    first, at = np.flatnonzero(new), np.empty(len(order), np.int64)
    at[order] = np.cumsum(new) - 1
    return hashes[order][first], np.add.reduceat(counts[order], first), at


# --- the corpus in chunks ------------------------------------------------------

_WIDTH = {1: 8, 2: 5}   # bytes of a word's and a bigram's hash


def _chunked(rows: DataFrame) -> DataFrame:
    """(chunk, data): the rows (doc_id, held_out, text) in compressed chunks of about CHUNK_BYTES of text."""
    def run(batches):
        task, done, held, size = TaskContext.get().partitionId(), 0, [], 0

        def out():
            sink = pa.BufferOutputStream()
            table = pa.Table.from_batches(held)
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(table)
            return pa.record_batch([pa.array([task << 32 | done]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["chunk", "data"])

        for batch in batches:
            text = textnp.strings(batch.column("text"))
            for lo, hi in textnp.chunks(text):
                held.append(pa.record_batch([batch.column("doc_id").slice(lo, hi - lo), batch.column("held_out").slice(lo, hi - lo), text.slice(lo, hi - lo)], names=["doc_id", "held_out", "text"]))
                size += held[-1].nbytes
                if size >= CHUNK_BYTES:
                    yield out()
                    done, held, size = done + 1, [], 0
        if held:
            yield out()

    return rows.mapInArrow(run, "chunk long, data binary")


def _opened(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all().combine_chunks()


def _grams(table: pa.Table) -> tuple[np.ndarray, np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """(text index, held out of each token, kind: (distinct hashes, their place at each token)) of a chunk."""
    word, doc, pair = tokens(textnp.strings(table.column("text")))
    held = np.asarray(table.column("held_out").combine_chunks().to_numpy(zero_copy_only=False), bool)[doc]
    return doc, held, {1: np.unique(word, return_inverse=True), 2: np.unique(pair, return_inverse=True)}


def _by_slice(hashes: np.ndarray, slices: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the hashes by slice, slices that occur, where each begins and the last ends)."""
    part = (hashes % U64(slices)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    first = np.flatnonzero(np.diff(part[order], prepend=-1))
    return order, part[order][first], np.append(first, len(order))


def _counted(chunks: DataFrame, slices: int) -> DataFrame:
    """(chunk, slice, kind, blob): the n-grams of each chunk, words (kind 1) and bigrams (2), with their counts in training texts."""
    def run(batches):
        for batch in batches:
            for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("data"), strict=True):
                _, held, grams = _grams(_opened(data.as_py()))
                for kind, (hashes, at) in grams.items():
                    count = np.bincount(at, ~held, len(hashes)).astype(np.int64)
                    order, part, edge = _by_slice(hashes, slices)
                    what = short(hashes) if kind == 2 else hashes
                    blobs = [_blob(what[mine], count[mine], _WIDTH[kind]) for mine in (order[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True))]
                    yield pa.record_batch([pa.array([chunk] * len(part), pa.int64()), pa.array(part, pa.int32()), pa.array([kind] * len(part), pa.int32()),
                                           pa.array(blobs, pa.binary())], names=["chunk", "slice", "kind", "blob"])

    return chunks.mapInArrow(run, "chunk long, slice int, kind int, blob binary")


_SLICE = "chunk long, slice int, kind int, blob binary, n long, total long, mass double, miss double, bytes long"
_SLICE_ARROW = pa.schema([("chunk", pa.int64()), ("slice", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary()), ("n", pa.int64()), ("total", pa.int64()),
                          ("mass", pa.float64()), ("miss", pa.float64()), ("bytes", pa.int64())])


def _merged(counts: DataFrame, answers: bool) -> DataFrame:
    """Each slice's sums and filter: a row of kind 0 with its numbers; with ``answers`` the levels of each chunk's n-grams
    (kinds 1 and 2, words with their exact counts), else its filter (kind 3) and vocabulary (4)."""
    def merge(key, table):
        part, kind = key[0].as_py(), table.column("kind").to_pylist()
        parts = [_unblob(b.as_py(), _WIDTH[k]) for k, b in zip(kind, table.column("blob"), strict=True)]
        none = np.zeros(0, U64), np.zeros(0, np.int64)
        sums = {want: _sum(*(np.concatenate(c) for c in zip(none, *(p for p, k in zip(parts, kind, strict=True) if k == want), strict=True))) for want in (1, 2)}
        seen = {k: (h[c > 0], c[c > 0]) for k, (h, c, _) in sums.items()}
        words = filter_words(np.concatenate([seen[1][0], keys(seen[2][0])]), np.concatenate([seen[1][1], seen[2][1]]))
        out = [{"chunk": -1, "slice": part, "kind": 0, "n": len(seen[1][0]), "total": int(seen[1][1].sum()), "mass": float(represented(*quantised(seen[1][1])).sum()),
                "miss": false_hits(words), "bytes": words.nbytes + 12 * len(seen[1][0])}]
        if not answers:
            out += [{"chunk": -1, "slice": part, "kind": 3, "blob": words.astype("<u8").tobytes()}, {"chunk": -1, "slice": part, "kind": 4, "blob": _blob(*seen[1], 8)}]
        else:
            # each distinct n-gram is probed once, whatever number of chunks asks for it
            model, codes, used = LogFilter(words, np.array([0, len(words)])), {}, {1: 0, 2: 0}
            for k, (hashes, _, _) in sums.items():
                level, digits = model.codes(keys(hashes) if k == 2 else hashes, np.zeros(len(hashes), np.int64))
                codes[k] = (level << DIGITS | digits).astype("<u2")
            for chunk, k, (hashes, _) in zip(table.column("chunk").to_pylist(), kind, parts, strict=True):
                at = sums[k][2][used[k]:used[k] + len(hashes)]
                used[k] += len(hashes)
                exact = _pack(sums[1][1][at]) if k == 1 else b""
                out.append({"chunk": chunk, "slice": part, "kind": k, "blob": len(hashes).to_bytes(8, "little") + codes[k][at].tobytes() + exact})
        return pa.Table.from_pylist(out, schema=_SLICE_ARROW)

    return counts.groupBy("slice").applyInArrow(merge, _SLICE)


def _numbers(merged: DataFrame, slices: int) -> tuple[int, int, float, float, int]:
    """(N, V, mass, ghost, bytes of filter and vocabulary) over all slices."""
    r = merged.where("kind = 0").agg(*[F.sum(c).alias(c) for c in ("n", "total", "mass", "miss", "bytes")]).first()
    v = r.n or 0
    return r.total or 0, v, r.mass or 0.0, v * (r.miss or 0.0) / slices, r.bytes or 0


def _scored(table: pa.Table, doc: np.ndarray, exact: np.ndarray, score: np.ndarray, n: int, v: int) -> pa.Table:
    """The result's rows of a chunk: ``exact`` are the training counts of its tokens."""
    m = table.num_rows
    length = np.bincount(doc, minlength=m)
    return pa.table([table.column("doc_id"), table.column("held_out"), pa.array(length, pa.int64()), pa.array(np.bincount(doc, exact > 0, m).astype(np.int64)),
                     pa.array(np.full(m, n, np.int64)), pa.array(np.bincount(doc, np.log10(exact + 1), m) - length * np.log10(n + v + 1)), pa.array(score)], names=_OUT)


def _lookup(known: np.ndarray, values: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, values[at], 0).astype(np.int64)


def collected(merged: DataFrame, slices: int) -> tuple[LogFilter, np.ndarray, np.ndarray]:
    """The whole filter and the vocabulary (hashes, counts) from their slices; the caller has checked their size."""
    _, v, mass, ghost, _ = _numbers(merged, slices)
    found, words, counts = {}, [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    for r in merged.where("kind > 2").select("slice", "kind", "blob").toLocalIterator():
        if r.kind == 3:
            found[r.slice] = np.frombuffer(r.blob, "<u8")
        else:
            h, c = _unblob(bytes(r.blob), 8)
            words.append(h)
            counts.append(c)
    hashes, count = np.concatenate(words), np.concatenate(counts)
    order = np.argsort(hashes)
    edge = np.concatenate([[0], np.cumsum([len(found.get(s, ())) for s in range(slices)])])
    flat = np.concatenate([np.zeros(0, "<u8"), *(found[s] for s in sorted(found))]).astype(U64, copy=False)
    count = count[order]
    return LogFilter(flat, edge, v, mass, ghost), hashes[order], count.astype(np.uint32) if count.max(initial=0) < 1 << 32 else count


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, fold: int = 2, max_bytes: int = MAX_BYTES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row; documents whose
    crc32(doc_id as text) mod ``folds`` is ``fold`` are held out of training."""
    spark = docs.sparkSession
    ship(spark)
    key = F.col(id_col).cast("long")
    held = F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds == fold
    rows = docs.select(key.alias("doc_id"), held.alias("held_out"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(8, round(size / 8 / PER_SLICE))
    chunks = stored(_chunked(rows), "lm-chunks")
    counts = _counted(chunks, slices)
    # the tables have about as many bytes as the texts; whether they fit is checked on the tables themselves
    if size <= max_bytes:
        merged = stored(_merged(counts, answers=False), "lm-filter")
        n, v, _, _, need = _numbers(merged, slices)
        if need <= max_bytes:
            return _scored_by_broadcast(chunks, merged, slices, n, v)
    merged = stored(_merged(counts, answers=True), "lm-answers")
    return _scored_by_answers(chunks, merged, slices)


def _scored_by_broadcast(chunks: DataFrame, merged: DataFrame, slices: int, n: int, v: int) -> DataFrame:
    shared = chunks.sparkSession.sparkContext.broadcast(collected(merged, slices))

    def run(batches):
        model, words, count = shared.value
        for batch in batches:
            for data in batch.column("data"):
                table = _opened(data.as_py())
                doc, _, grams = _grams(table)
                (one, at), (two, at_two) = grams[1], grams[2]
                score = model.log_probability(one[at], doc, two[at_two], table.num_rows)
                yield from _scored(table, doc, _lookup(words, count, one)[at], score, n, v).to_batches()

    return chunks.mapInArrow(run, _KINDS)


def _scored_by_answers(chunks: DataFrame, merged: DataFrame, slices: int) -> DataFrame:
    n, v, mass, ghost, _ = _numbers(merged, slices)

    def finish(key, own, answers):
        table = _opened(own.column("data")[0].as_py())
        doc, _, grams = _grams(table)
        count, exact = {}, np.zeros(0, np.int64)
        given = {(k, s): b for k, s, b in zip(answers.column("kind").to_pylist(), answers.column("slice").to_pylist(), answers.column("blob"), strict=True)}
        for kind, (hashes, at) in grams.items():
            order, part, edge = _by_slice(hashes, slices)
            code, plain = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
            for s, a, b in zip(part.tolist(), edge[:-1], edge[1:], strict=True):
                data = given[kind, s].as_py()
                if int.from_bytes(data[:8], "little") != b - a:
                    raise ValueError("a slice answered for another chunk")
                code[order[a:b]] = np.frombuffer(data, "<u2", b - a, 8)
                if kind == 1:
                    plain[order[a:b]] = _unpack(data, b - a, 8 + 2 * (b - a))
            count[kind] = represented(code >> DIGITS, code & (1 << DIGITS) - 1)[at]
            exact = plain[at] if kind == 1 else exact
        return _scored(table, doc, exact, _smoothed(count[1], count[2], doc, table.num_rows, v, mass, ghost), n, v)

    answers = merged.where("kind in (1, 2)").select("chunk", "slice", "kind", "blob")
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(finish, _KINDS)
