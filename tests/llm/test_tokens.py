import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from period_etl.llm import bpe, rans
from period_etl.session import scratch_dir
from tests.llm.conftest import rows

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TEXT = st.lists(st.sampled_from(list("ab'sdtrevml 12!?.\n\t\r  \x85　éΣİ漢😀<|>") + ["<|endoftext|>", "<|startoftext|>"]), max_size=40).map("".join)


def library(path):
    t = Tokenizer.from_file(path)
    t.no_padding()
    t.no_truncation()
    return t


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, max_size=5))
def test_ids_are_the_librarys(texts):
    for model, path in ((_word(), WORD), (_byte(), BYTE)):
        want = [e.ids for e in _library(path).encode_batch(texts, add_special_tokens=False)]
        assert [i.tolist() for i in model.encode(texts)] == want


_made = {}


def _word():
    return _made.setdefault("word", bpe.load(WORD))


def _byte():
    return _made.setdefault("byte", rans.PieceTokenizer(open(BYTE, encoding="utf-8").read()))


def _library(path):
    if path not in _made:
        _made[path] = library(path)
    return _made[path]


def test_bpe_digest(docs, no_docs):
    t, want = library(WORD), []
    for doc, text in rows():
        ids = t.encode(text or "", add_special_tokens=False).ids
        want.append((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, bpe.bpe_digest(docs, WORD).collect()), key=str) == sorted(want, key=str)
    assert bpe.bpe_digest(no_docs, WORD).collect() == []


def test_another_kind_of_tokenizer_is_refused():
    with pytest.raises(ValueError):
        bpe.load(BYTE)
    with pytest.raises(ValueError):
        rans.PieceTokenizer(open(WORD, encoding="utf-8").read())


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 70_000), st.integers(1, 60_000), st.integers(0, 9))
def test_segment_round_trip(n, width, seed):
    ids = np.random.default_rng(seed).integers(0, width, n) ** 2 // width
    assert (rans.decode_blocks(*rans.encode_segment(ids)) == ids).all()


def test_blocks_decode_from_their_checkpoints_and_damage_is_found():
    ids = np.arange(100_000) % 977
    table, blocks, states, words = rans.encode_segment(ids)
    assert (rans.decode_blocks(table, blocks, states, words, 2, 4) == ids[2 * rans.BLOCK:4 * rans.BLOCK]).all()
    with pytest.raises(ValueError):
        rans.decode_blocks(table, blocks, states, words[:500] + bytes([words[500] ^ 1]) + words[501:])
    with pytest.raises(ValueError):
        rans.decode_blocks(table, blocks, states[:8] + bytes([states[8] ^ 1]) + states[9:], words)


def test_token_files(spark, docs, no_docs):
    out = scratch_dir(spark, "tokens")
    rans.write_token_files(docs, out, BYTE, end_id=2, segment=5_000)
    t, want, at = library(BYTE), [], 0
    got = sorted((tuple(r) for r in rans.read_token_files(spark, out).collect()), key=lambda r: r[1])
    order = [r[0] for r in got]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    texts = {}
    for doc, text in rows():
        texts.setdefault(doc, []).append(np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4").tobytes())
    for doc, start, n, crc, ids in got:
        assert start == at and n == len(ids) // 4 and crc == zlib.crc32(ids)
        texts[doc].remove(bytes(ids))
        at += n
    assert not any(texts.values())
    out = scratch_dir(spark, "tokens")
    rans.write_token_files(no_docs, out, BYTE, end_id=2)
    assert rans.read_token_files(spark, out).collect() == [] and want == []
