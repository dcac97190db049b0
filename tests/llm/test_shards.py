import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from period_etl.llm import binpack
from period_etl.session import scratch_dir
from tests.llm.conftest import prose, rows


def check(got, data, shards):
    want = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), "bytes", None) for d, t in data)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.grown_shard) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        assert 0 <= r.shard < shards
        slots[r.shard].append((r.slot, r.doc_id is not None, r.doc_id or 0))
    for s in slots.values():
        assert sorted(x[0] for x in s) == list(range(len(s))) and [x[1:] for x in sorted(s)] == sorted(x[1:] for x in s)


def test_whole_table_is_placed(docs, no_docs):
    check(binpack.assign_shards(docs, 4).collect(), rows(), 4)
    assert binpack.assign_shards(no_docs).collect() == []


@pytest.mark.parametrize("per_lot", [20_000, 320])
def test_near_equal_bytes_and_whole_groups(spark, per_lot):
    """A text that a third of all rows share is cut, one of half a share and all others stay whole; in one round and in several."""
    data = [(i, prose(i, 20 + i % 90)) for i in range(600)] + [(1000 + i, prose(3, 60)) for i in range(300)] + [(2000 + i, prose(i, 20 + i % 90)) for i in range(0, 60, 2)]
    data += [(3000 + i, prose(900, 60)) for i in range(50)] + [(None, None)] * 3
    got = binpack.assign_shards(spark.createDataFrame(data, "doc_id long, text string").repartition(3), 10, per_lot=per_lot).collect()
    check(got, data, 10)
    size, text, where, bytes_ = Counter(), dict(data), defaultdict(set), Counter()
    for r in got:
        size[r.shard] += r.size
        where[text[r.doc_id]].add(r.shard)
        bytes_[text[r.doc_id]] += r.size
    mean = sum(size.values()) / 10
    assert 0.96 * mean < min(size.values()) and max(size.values()) < 1.04 * mean
    assert 0.4 * mean < bytes_[prose(900, 60)] < mean < bytes_[prose(3, 60)]
    assert all(len(s) == 1 for t, s in where.items() if t != prose(3, 60)) and len(where[prose(3, 60)]) > 1


def test_three_rounds(spark):
    data = [(i, prose(i, 5 + i % 30)) for i in range(900)]
    got = binpack.assign_shards(spark.createDataFrame(data, "doc_id long, text string").repartition(3), 2, per_lot=64).collect()
    check(got, data, 2)
    size = Counter()
    for r in got:
        size[r.shard] += r.size
    assert max(size.values()) < 1.02 * min(size.values())


def test_equal_rows_beyond_a_share_are_cut(spark):
    data = [(None, "same")] * 400 + [(i, prose(i, 3)) for i in range(400)]
    got = binpack.assign_shards(spark.createDataFrame(data, "doc_id long, text string").repartition(3), 8).collect()
    check(got, data, 8)
    size = Counter()
    for r in got:
        size[r.shard] += r.size
    assert max(size.values()) < 1.1 * sum(size.values()) / 8


def brute_place(items, shards):
    """Every bin tried for every item, residual capacities from what the bins hold."""
    total, held, out = [sum(c) for c in zip(*items, strict=True)], [[0.0] * 3 for _ in range(shards)], []
    for item in items:
        size = [x * shards / t for x, t in zip(item, total, strict=True)]
        dots = [sum(w * s * (1 - h * shards / t) for w, s, h, t in zip((8, 1, 1), size, own, total, strict=True)) for own in held]
        best = max(dots)
        out.append(next(b for b, d in enumerate(dots) if d > best - 1e-9))
        held[out[-1]] = [h + x for h, x in zip(held[out[-1]], item, strict=True)]
    return out


def test_highest_dot_product_is_chosen():
    rng = np.random.default_rng(3)
    for items in ([(8, 1, 1), (1, 8, 1), (8, 1, 1), (1, 8, 1)], rng.integers(1, 50, (60, 3)).tolist()):
        bins = binpack.Bins(4, np.sum(items, 0).astype(float))
        assert [bins.place(np.array(i, float)) for i in items] == brute_place(items, 4)


def test_packing_of_a_lot_equals_brute_force(spark):
    """The frame's placement, lot by lot, largest first."""
    rng = np.random.default_rng(4)
    data = [(int(i), int(rng.integers(3)), *map(int, rng.integers(1, 60, 3))) for i in range(90)]
    frame = spark.createDataFrame(data, "k long, lot int, bytes long, tokens long, rows long").repartition(4)
    got = {r.k: r.bin for r in binpack._packed(frame, ["k"], 5).collect()}
    for lot in range(3):
        mine = sorted((r for r in data if r[1] == lot), key=lambda r: (-r[2], -r[3], r[0]))
        assert [got[r[0]] for r in mine] == brute_place([r[2:] for r in mine], 5)


def test_written_shards(spark, docs):
    out = scratch_dir(spark, "shards")
    binpack.write_shards(docs, out, 4)
    back = spark.read.parquet(out).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter(rows())
    assert len({(r["shard"], r.slot) for r in back}) == len(back)
