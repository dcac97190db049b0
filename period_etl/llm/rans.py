"""Token-id files coded by a static range asymmetric numeral system.

The documents, in ascending id order over range partitions, are tokenised and
coded in one pass. The files are Parquet; a row is a segment: the next whole
documents up to about ``SEGMENT`` ids. All blocks of a segment share one
frequency table, normalised to 2**18. A block of ``BLOCK`` ids is coded by
itself with ``LANES`` interleaved states that write 32-bit words, so
any block can be decoded from its checkpoint: where its words begin, how many
ids it has, its final states and the CRC-32 of its words and of its ids. numpy
advances the lanes of all blocks of a segment together. Memory is bounded by a
segment, or by the longest document if that has more ids.

Rows: a null text is an empty text and has the end id only. Rows of the same
doc_id follow each other, ordered by their text's hash; null doc_ids come
first. Columns other than the two named are not read. A damaged segment raises
ValueError when read.
"""

from __future__ import annotations

import json
import os
import zlib
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from period_etl.llm import textnp
from period_etl.llm.bpe import byte_symbols
from period_etl.llm.common import parts, ship
from period_etl.llm.pieces import PieceCache

#: The frequencies' sum, the states' lower bound and the words' width, as powers of two.
BITS, LOW_BITS, WORD_BITS = 18, 20, 32
LANES, BLOCK, SEGMENT = 32, 16_384, 2 << 20
_NO_U32 = np.zeros(0, "<u4")

SCHEMA = ("part int, segment int, start long, n_tokens long, doc_ids array<long>, doc_tokens array<int>, table binary, "
          "blocks binary, states binary, words binary")
_BLOCK = np.dtype([("word", "<u8"), ("n_words", "<u4"), ("n_ids", "<u4"), ("words_crc", "<u4"), ("ids_crc", "<u4")])


# --- coder -----------------------------------------------------------------

def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids that occur, their frequencies): each at least 1, 2**BITS together."""
    symbol, count = np.unique(ids, return_counts=True)
    if len(symbol) > 1 << BITS:
        raise ValueError("more distinct ids than the table can hold")
    spare = (1 << BITS) - len(symbol)
    freq = 1 + count.astype(np.int64) * spare // count.sum()
    freq[np.argmax(count)] += (1 << BITS) - freq.sum()
    return symbol.astype("<u4"), freq


def encode_segment(ids: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    """(table, blocks, states, words) of the ids, one or more."""
    symbol, freq = frequencies(ids)
    table = zlib.compress(np.concatenate([[len(symbol)], symbol, freq]).astype("<u4").tobytes())
    n_blocks, steps = -(-len(ids) // BLOCK), -(-min(len(ids), BLOCK) // LANES)
    size = np.full(n_blocks, BLOCK)
    size[-1] = len(ids) - BLOCK * (n_blocks - 1)
    # what fills the last block has all of the range, so it leaves its states as they are
    rank = np.full(n_blocks * BLOCK, len(symbol), np.int32)
    number = np.zeros(int(symbol[-1]) + 1, np.int32)
    number[symbol] = np.arange(len(symbol))
    rank[:len(ids)] = number[ids]
    rank = np.ascontiguousarray(rank.reshape(n_blocks, BLOCK // LANES, LANES)[:, :steps].transpose(1, 0, 2)).reshape(steps, -1)
    f, base = np.append(freq, 1 << BITS), np.append(np.cumsum(freq) - freq, 0)
    limit, gap, f = f << WORD_BITS + LOW_BITS - BITS, (1 << BITS) - f, f.astype(np.float64)
    x = np.full(n_blocks * LANES, 1 << LOW_BITS)
    wrote, emitted = np.zeros(rank.shape, bool), np.zeros(rank.shape, "<u4")
    for t in range(steps - 1, -1, -1):
        now = rank[t]
        full = x >= limit[now]
        wrote[t], emitted[t] = full, x
        x = np.where(full, x >> WORD_BITS, x)
        # states stay below 2**52: a division of doubles, rounded down, is exact
        x += (x / f[now]).astype(np.int64) * gap[now] + base[now]
    wrote, emitted = (a.reshape(steps, n_blocks, LANES).transpose(1, 0, 2) for a in (wrote, emitted))
    words, n_words = emitted[wrote], wrote.sum((1, 2))
    first = np.cumsum(n_words) - n_words
    blocks = np.zeros(n_blocks, _BLOCK)
    blocks["word"], blocks["n_words"], blocks["n_ids"] = first, n_words, size
    data, plain = words.tobytes(), ids.astype("<u4").tobytes()
    for i in range(n_blocks):
        blocks["words_crc"][i] = zlib.crc32(data[4 * first[i]:4 * (first[i] + n_words[i])])
        blocks["ids_crc"][i] = zlib.crc32(plain[4 * BLOCK * i:4 * BLOCK * (i + 1)])
    return table, blocks.tobytes(), x.astype("<u8").tobytes(), data


def decode_blocks(table: bytes, blocks: bytes, states: bytes, words: bytes, lo: int = 0, hi: int | None = None) -> np.ndarray:
    """The ids of blocks ``lo`` to ``hi`` (all by default); ValueError if a checksum fails."""
    try:
        head = np.frombuffer(zlib.decompress(table), "<u4").astype(np.int64)
    except zlib.error as e:
        raise ValueError("damaged frequency table") from e
    symbol, freq = head[1:1 + head[0]], head[1 + head[0]:]
    index = np.frombuffer(blocks, _BLOCK)[lo:hi]
    x = np.frombuffer(states, "<u8").reshape(-1, LANES)[lo:hi].astype(np.int64)
    for b in index:
        if zlib.crc32(words[4 * int(b["word"]):4 * int(b["word"] + b["n_words"])]) != b["words_crc"]:
            raise ValueError("damaged block")
    if not len(index):
        return _NO_U32
    if freq.sum() != 1 << BITS:
        raise ValueError("damaged frequency table")
    slot = np.repeat(np.arange(len(symbol), dtype=np.int32), freq)
    base = np.cumsum(freq) - freq
    size, at = index["n_ids"].astype(np.int64), index["word"].astype(np.int64)[:, None] - 1
    steps = -(-int(size.max()) // LANES)
    out = np.zeros((steps, *x.shape), np.int32)
    # a lane past its block's last id reads on, after the lanes that still have ids; what it gives is cut off
    word = np.append(np.frombuffer(words, "<u4"), np.zeros(LANES * 2, "<u4")).astype(np.int64)
    for t in range(steps):
        low = x & (1 << BITS) - 1
        now = out[t] = slot[low]
        x = freq[now] * (x >> BITS) + low - base[now]
        need = x < 1 << LOW_BITS
        place = at + np.cumsum(need, 1)
        at = place[:, -1:]
        x = np.where(need, x << WORD_BITS | word[np.minimum(place, len(word) - 1)], x)
    flat = out.transpose(1, 0, 2).reshape(len(index), -1)
    ids = symbol.astype("<u4")[flat[np.arange(steps * LANES) < size[:, None]]]
    plain, edge = ids.tobytes(), np.concatenate([[0], np.cumsum(size)])
    for i, b in enumerate(index):
        if zlib.crc32(plain[4 * edge[i]:4 * edge[i + 1]]) != b["ids_crc"]:
            raise ValueError("damaged ids")
    return ids


# --- tokens ----------------------------------------------------------------

class PieceTokenizer:
    """A byte-level tokenizer file of the tokenizers library, applied to each distinct piece of its pattern once.

    The pattern cuts a text into pieces that are encoded independently, so the
    ids are those of the whole text. Texts with a special token's string are
    given to the library whole.
    """

    def __init__(self, source: str):
        spec = json.loads(source)
        pre = spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or not pre["use_regex"] or pre["add_prefix_space"]:
            raise ValueError("a tokenizer file of another kind")
        self.source, self.special = source, [t["content"] for t in spec["added_tokens"]]

    def __getstate__(self):
        return {"source": self.source, "special": self.special}

    def _ready(self) -> None:
        if not hasattr(self, "cache"):
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_str(self.source)
            self.library.no_padding()
            self.library.no_truncation()
            self.model, self.symbols = self.library.model, dict(enumerate(byte_symbols()))
            self.cache = PieceCache(self._pieces, attach_space=True)

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        tokenize, symbols = self.model.tokenize, self.symbols
        ids = [[t.id for t in tokenize(p.encode().decode("latin-1").translate(symbols))] for p in pieces]
        at = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
        return np.fromiter(chain.from_iterable(ids), np.uint32, at[-1]), at

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        self._ready()
        whole = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        skip = set(whole)
        out = self.cache.ids(["" if i in skip else t for i, t in enumerate(texts)])
        for i in whole:
            out[i] = np.array(self.library.encode(texts[i], add_special_tokens=False).ids, np.uint32)
        return out


# --- files -----------------------------------------------------------------

def write_token_files(docs: DataFrame, out: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                      segment: int = SEGMENT) -> None:
    """Write the documents' ids, each document's followed by ``end_id``, as coded files under ``out``."""
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(PieceTokenizer(Path(tokenizer).read_text(encoding="utf-8")))
    end = np.array([end_id], np.uint32)

    def run(batches):
        part, number, start, ids, lists, held = TaskContext.get().partitionId(), 0, 0, [], [], 0

        def row():
            flat = np.concatenate(lists)
            table, blocks, states, words = encode_segment(flat)
            return pa.RecordBatch.from_pylist([{
                "part": part, "segment": number, "start": start, "n_tokens": len(flat), "doc_ids": ids,
                "doc_tokens": [len(x) for x in lists], "table": table, "blocks": blocks, "states": states, "words": words}], schema=arrow)

        for batch in batches:
            text = textnp.strings(batch.column(1))
            for lo, hi in textnp.chunks(text):
                for key, tokens in zip(batch.column(0).slice(lo, hi - lo).to_pylist(), model.value.encode(text.slice(lo, hi - lo).to_pylist()), strict=True):
                    if lists and held + len(tokens) + 1 > segment:
                        yield row()
                        number, start, ids, lists, held = number + 1, start + held, [], [], 0
                    ids.append(key)
                    lists.append(np.concatenate([tokens, end]))
                    held += len(tokens) + 1
        if lists:
            yield row()

    arrow = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                       ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int32())), ("table", pa.binary()),
                       ("blocks", pa.binary()), ("states", pa.binary()), ("words", pa.binary())])
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
    n = parts(spark, 1)
    rows = rows.repartitionByRange(n, "id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    rows.mapInArrow(run, SCHEMA).write.option("compression", "uncompressed").parquet(out)


def read_token_files(spark: SparkSession, path: str, as_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) for each document of the files; ids only if asked for.

    ``start`` counts the ids of all documents before it; only the id count of
    each written part passes through the driver.
    """
    ship(spark)
    files = spark.read.schema(SCHEMA).parquet(path)
    total, before = 0, {}
    for r in sorted(files.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()):
        before[r.part], total = total, total + r.n
    offset = spark.sparkContext.broadcast(before)

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1).to_pylist()[0]
                plain = decode_blocks(row["table"], row["blocks"], row["states"], row["words"]).tobytes()
                size = np.array(row["doc_tokens"], np.int64)
                edge = np.concatenate([[0], np.cumsum(size)])
                each = [plain[4 * a:4 * b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
                columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(edge[:-1] + (offset.value[row["part"]] + row["start"])),
                           pa.array(size), pa.array([zlib.crc32(x) for x in each], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if as_ids:
                    columns, names = [*columns, pa.array(each, pa.binary())], [*names, "ids"]
                yield pa.record_batch(columns, names=names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * as_ids
    return files.mapInArrow(run, schema)
