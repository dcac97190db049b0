import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from period_etl.llm import packing
from period_etl.session import scratch_dir
from tests.llm.conftest import rows

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def brute_pack(sizes, capacity):
    """Every open sequence tried for each piece: its gap, and what the sum of squares would be."""
    gaps = []
    for size in sizes:
        def squares(i, size=size):
            after = [g - size if j == i else g for j, g in enumerate(gaps)]
            return sum(n * n for g, n in Counter(after).items() if g)
        fits = [i for i, g in enumerate(gaps) if g >= size]
        if not fits:
            gaps.append(capacity - size)
        else:
            best = min(fits, key=lambda i: (squares(i), gaps[i]))
            gaps[best] -= size
    return sorted(gaps)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=40))
def test_packer_keeps_the_sum_of_squares_least(sizes):
    packer, used = packing.Packer(12), defaultdict(int)
    for size in sizes:
        number, offset = packer.place(size)
        assert offset == used[number]
        used[number] += size
    assert sorted(12 - u for u in used.values()) == brute_pack(sizes, 12) and packer.made == len(used)


def test_pieces_cut_only_long_documents():
    assert packing.pieces(10, 10) == [(0, 10)] and packing.pieces(9, 10) == [(0, 9)]
    assert packing.pieces(25, 10) == [(0, 5), (5, 10), (15, 10)] and packing.pieces(20, 10) == [(0, 10), (10, 10)]


def expected(capacity):
    library = Tokenizer.from_file(BYTE)
    out = []
    for doc, text in rows():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        cut = len(ids) % capacity or capacity
        edges = [0, *range(cut, len(ids) + 1, capacity)]
        out += [(doc, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
    return sorted(out, key=str)


def test_pieces_fill_sequences_without_gaps(docs, no_docs):
    for capacity, per_lot in ((1024, 32_768), (64, 10)):
        got = [tuple(r) for r in packing.pack_documents(docs, BYTE, 2, capacity, per_lot=per_lot).collect()]
        assert sorted((r[:5] for r in got), key=str) == expected(capacity)
        held = defaultdict(list)
        for r in got:
            held[r[5]].append((r[6], r[3]))
        for spans in held.values():
            spans.sort()
            assert [a for a, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))] and sum(n for _, n in spans) <= capacity
        if per_lot > 100:
            assert len(held) == len(brute_pack(sorted((r[3] for r in got), reverse=True), capacity))
    assert packing.pack_documents(no_docs, BYTE, 2).collect() == []


def test_equal_rows_do_not_share_one_lot(spark):
    same = spark.createDataFrame([(None, "one two three")] * 600, "doc_id long, text string").repartition(3)
    got = packing.pack_documents(same, BYTE, 2, 64, per_lot=50).collect()
    lots = Counter(r.sequence_id >> 40 for r in got)
    assert len(got) == 600 and len(lots) == 12 and max(lots.values()) <= 52


def test_written_sequences_hold_the_pieces(docs, spark):
    out = scratch_dir(spark, "sequences")
    packing.write_sequences(docs, out, BYTE, 2, 64)
    pieces = []
    for r in spark.read.parquet(out).collect():
        ids = np.frombuffer(r.ids, "<u4")
        edges = [*r.offsets, len(ids)]
        assert len(ids) <= 64 and edges[0] == 0
        pieces += [(d, zlib.crc32(ids[a:b].tobytes())) for d, a, b in zip(r.doc_ids, edges, edges[1:], strict=False)]
    assert sorted(pieces, key=str) == sorted(((e[0], e[4]) for e in expected(64)), key=str)
