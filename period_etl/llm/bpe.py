"""Byte-pair encoding and decoding of whole texts by batched numpy merge rounds.

A tokenizer file of the tokenizers library (its JSON format) gives the merges.
The symbols of all distinct words of a batch stand in one flat array. A round
forms the keys of all neighbouring pairs, finds their ranks by binary search
over the sorted pair keys, and merges in each word the pairs of its lowest
rank, from left to right. Words without a known pair leave the array, so the
rounds are as many as the merges of the batch's longest word.

Handled are files with: BPE without drop-out, byte-level symbols, an optional
word-end suffix, the normalisers NFC, Replace by a pattern and Lowercase, a
Split pre-tokeniser that keeps its matches, and special tokens that match in
raw text. Others raise ValueError. Truncation and padding are not applied.

Rows: a null text is an empty text; an empty text has no ids and decodes to
the empty text. Every row gives one row, in any order; repeated rows stay, and
columns other than the named ones are not read. Ids are binary columns,
little-endian unsigned 32-bit integers one after the other.
"""

from __future__ import annotations

import json
import unicodedata
from hashlib import sha256
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from period_etl.llm import textnp
from period_etl.llm.common import ship
from period_etl.llm.pieces import ENDINGS, PieceCache

#: The pattern whose matches are the words (fixed value); pieces.cut() finds them.
PATTERN = "|".join("'" + e for e in ENDINGS) + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NO_RANK = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the rest from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


class BpeModel:
    """The tables of one tokenizer file, and what encodes and decodes with them."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model, pre = spec["model"], spec["pre_tokenizer"]
        steps = pre["pretokenizers"] if pre["type"] == "Sequence" else [pre]
        if (model["type"] != "BPE" or model["dropout"] or model.get("unk_token") or spec["decoder"] is not None
                or [s["type"] for s in steps] != ["Split", "ByteLevel"] or steps[0]["behavior"] != "Removed"
                or not steps[0]["invert"] or steps[1]["use_regex"] or steps[1]["add_prefix_space"]
                or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])):
            raise ValueError("a tokenizer file of another kind")
        normal = spec["normalizer"]
        self.normal = []
        for step in (normal["normalizers"] if normal["type"] == "Sequence" else [normal]) if normal else []:
            if step["type"] not in ("NFC", "Lowercase", "Replace"):
                raise ValueError(f"normaliser {step['type']}")
            self.normal.append((step["type"], step.get("pattern", {}).get("Regex", ""), step.get("content", "")))
        if steps[0]["pattern"] != {"Regex": PATTERN}:
            raise ValueError("a tokenizer file with another pattern")
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.width = len(self.tokens)
        suffix = model["end_of_word_suffix"] or ""
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols])
        self.last = np.array([vocab[s + suffix] for s in symbols])
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        key = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs])
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = key[order], order.astype(np.int64)
        cut = len(suffix)
        self.merged = np.array([vocab[(a[:-cut] if cut and a.endswith(suffix) else a) + b] for a, b in pairs])

    def _ready(self) -> None:
        if not hasattr(self, "cache"):
            self.rewrite = [(kind, regex.compile(p.replace(r"\s", r"\p{White_Space}")).sub if kind == "Replace" else None, content)
                            for kind, p, content in self.normal]
            self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
            self.cache = PieceCache(self.merge, attach_space=False)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("rewrite", "cut", "cache")}

    def normalised(self, text: str) -> str:
        for kind, sub, content in self.rewrite:
            if kind == "NFC":
                text = unicodedata.normalize("NFC", text)
            elif kind == "Lowercase":
                text = text.replace("Σ", "σ").lower()  # each character by itself: no final sigma
            else:
                text = sub(content, text)
        return text

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, where each word begins and the end)."""
        raw = [w.encode() for w in words]
        size = np.array([len(r) for r in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        sym, word = self.inner[data], np.repeat(np.arange(len(raw)), size)
        end = np.cumsum(size)
        sym[end[size > 0] - 1] = self.last[data[end[size > 0] - 1]]
        done_sym, done_word = [], []
        while len(sym):
            same = word[1:] == word[:-1]
            key = np.where(same, sym[:-1] * self.width + sym[1:], -1)
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.append(np.where(self.keys[found] == key, self.ranks[found], _NO_RANK), _NO_RANK)
            first = np.flatnonzero(np.append(True, ~same))
            lowest = np.minimum.reduceat(rank, first)
            length = np.diff(np.append(first, len(sym)))
            least = np.repeat(lowest, length)
            ended = least == _NO_RANK
            done_sym.append(sym[ended])
            done_word.append(word[ended])
            hit = (rank == least) & ~ended
            run = np.flatnonzero(hit)
            if len(run):  # neighbouring hits overlap: every second one of a run stays
                begin = np.append(True, np.diff(run) > 1)
                nth = np.arange(len(run)) - np.flatnonzero(begin)[np.cumsum(begin) - 1]
                run = run[nth % 2 == 0]
            sym = sym.copy()
            sym[run] = self.merged[rank[run]]
            keep = ~ended
            keep[run + 1] = False
            sym, word = sym[keep], word[keep]
        all_sym, all_word = np.concatenate([*done_sym, np.zeros(0, np.int64)]), np.concatenate([*done_word, np.zeros(0, np.int64)])
        order = np.argsort(all_word, kind="stable")
        return all_sym[order].astype(np.uint32), np.concatenate([[0], np.cumsum(np.bincount(all_word, minlength=len(raw)))])

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text. A special token's string stands for its id."""
        self._ready()
        texts = [t or "" for t in texts]
        split = {i: parts for i, t in enumerate(texts)
                 if self.cut and "<" in t and len(parts := self.cut.split(t)) > 1}
        plain = [self.normalised("" if i in split else t) for i, t in enumerate(texts)]
        inside = [self.normalised(p) for parts in split.values() for p in parts[::2]]
        ids = self.cache.ids(plain + inside)
        out, inside = ids[:len(texts)], iter(ids[len(texts):])
        for i, parts in split.items():
            out[i] = np.concatenate([np.array([self.special[p]], np.uint32) if j % 2 else next(inside) for j, p in enumerate(parts)])
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids: a file without a decoder joins the tokens by spaces."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


def load(path: str) -> BpeModel:
    return BpeModel(Path(path).read_text(encoding="utf-8"))


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids) for each row; ``path`` is a tokenizer file that the driver reads and broadcasts."""
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(load(path))

    def run(batches):
        for batch in batches:
            text = textnp.strings(batch.column(1))
            for lo, hi in textnp.chunks(text):
                ids = model.value.encode(text.slice(lo, hi - lo).to_pylist())
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary())],
                                      names=[id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids binary")


def bpe_decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """The encoded rows with a column ``decoded``; null ids decode to the empty text."""
    spark = encoded.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(load(path))

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(ids_col)
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                texts = [model.value.decode(np.frombuffer(b.as_py() or b"", "<u4")) for b in part.column(at)]
                yield pa.record_batch([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{schema}, decoded string")


def bpe_digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256) of each row, by encoding and then decoding it.

    Both happen in one pass of one worker a core; neither ids nor decoded texts leave it.
    """
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(load(path))
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches):
        for batch in batches:
            text = textnp.strings(batch.column(1))
            for lo, hi in textnp.chunks(text):
                ids = model.value.encode(text.slice(lo, hi - lo).to_pylist())
                yield pa.record_batch([
                    batch.column(0).slice(lo, hi - lo), pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids], pa.string()),
                    pa.array([sha256(model.value.decode(i).encode()).hexdigest() for i in ids], pa.string())], names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
