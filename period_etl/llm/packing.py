"""Best-fit packing of token sequences by sums of squares.

Documents are tokenised and end with one further id. Those of more than
``capacity`` ids are cut into pieces of that length, the first one taking what
is left over, so each document has at most one shorter piece. Pieces are dealt
in turn to lots of about ``PER_LOT`` documents, however equal they are; a lot
is packed in one task, longest piece first: each piece goes to the open
sequence that leaves the sum of the squared numbers of open sequences at each
residual gap smallest; a new one is opened only if none has room (opening one
whenever that keeps the sum lower took 1 percent more sequences on the given
documents, this rule 1 more than the ids need at least in 4,464). Full
sequences have no gap and don't count. Of sequences with the same gap the one
changed last takes the piece, of gaps with the same sum the smaller. A task
keeps a lot's open sequences only.

Rows: a null text is an empty text and has the end id only. Repeated rows and
null ids are pieces like any other. Columns other than the two named are not
read. An empty table has no sequence.
"""

from __future__ import annotations

import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from period_etl.llm import textnp
from period_etl.llm.common import parts, ship
from period_etl.llm.rans import PieceTokenizer

#: Documents of a lot, about.
PER_LOT = 32_768
_KINDS = "lot int, doc_id long, piece int, start long, length long, ids_crc32 long"


class Packer:
    """Sequences that fill up piece by piece; numbers of sequences count up from 0."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)        # open sequences at each gap; gap 0 stays 0
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.made = 0

    def place(self, size: int) -> tuple[int, int]:
        """(sequence, offset) of a piece of 1 to ``capacity`` ids."""
        have = np.flatnonzero(self.count[size:]) + size
        if len(have):
            # a sequence leaves its gap, (n - 1)**2 - n**2, and comes to the smaller one, (n + 1)**2 - n**2; gap 0 doesn't count
            left = have - size
            change = 1 - 2 * self.count[have] + np.where(left > 0, 2 * self.count[left] + 1, 0)
            gap = int(have[np.argmin(change)])
            number = self.open[gap].pop()
            self.count[gap] -= 1
        else:
            number, gap = self.made, self.capacity
            self.made += 1
        if gap > size:
            self.count[gap - size] += 1
            self.open[gap - size].append(number)
        return number, self.capacity - gap


def pieces(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of a document."""
    first = length % capacity
    return [(0, first)] * (first > 0) + [(s, capacity) for s in range(first, length, capacity)]


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text",
                   as_ids: bool = False, per_lot: int = PER_LOT) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), and ``ids`` if asked for, for each piece of each document."""
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(PieceTokenizer(Path(tokenizer).read_text(encoding="utf-8")))
    lots = max(1, -(-docs.count() // per_lot))
    end = np.array([end_id], np.uint32)
    names = ["lot", "doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * as_ids]
    arrow = pa.schema([("lot", pa.int32()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                       ("ids_crc32", pa.int64()), *[("ids", pa.binary())] * as_ids])

    def cut(batches):
        turn = TaskContext.get().partitionId()
        for batch in batches:
            text = textnp.strings(batch.column(1))
            for lo, hi in textnp.chunks(text):
                out: list[list] = [[] for _ in names]
                for key, ids in zip(batch.column(0).slice(lo, hi - lo).to_pylist(), model.value.encode(text.slice(lo, hi - lo).to_pylist()), strict=True):
                    plain = np.concatenate([ids, end]).astype("<u4").tobytes()
                    turn += 1
                    for number, (start, length) in enumerate(pieces(len(plain) // 4, capacity)):
                        mine = plain[4 * start:4 * (start + length)]
                        for column, value in zip(out, (turn % lots, key, number, start, length, zlib.crc32(mine), mine), strict=False):
                            column.append(value)
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(out, arrow, strict=True)], schema=arrow)

    def pack(batches):
        lot, packer = None, Packer(capacity)
        for batch in batches:
            number, offset = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for i, (now, size) in enumerate(zip(batch.column("lot").to_pylist(), batch.column("length").to_pylist(), strict=True)):
                if now != lot:
                    lot, packer = now, Packer(capacity)
                made, offset[i] = packer.place(size)
                number[i] = lot << 40 | made
            yield pa.record_batch([*batch.columns[1:], pa.array(number), pa.array(offset)], names=[*names[1:], "sequence_id", "offset"])

    kinds = _KINDS + ", ids binary" * as_ids
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, kinds)
    dealt = rows.repartition(min(lots, parts(spark, lots)), "lot").sortWithinPartitions("lot", F.desc("length"), "doc_id", "piece", "ids_crc32")
    return dealt.mapInArrow(pack, kinds.removeprefix("lot int, ") + ", sequence_id long, offset long")


def write_sequences(docs: DataFrame, out: str, tokenizer: str, end_id: int, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the packed sequences as Parquet: (sequence_id, ids, doc_ids, offsets), ids little-endian unsigned 32-bit integers."""
    packed = pack_documents(docs, tokenizer, end_id, capacity, id_col, text_col, as_ids=True)
    # a sequence has no more than capacity pieces
    held = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))
    held.select("sequence_id", F.aggregate("p.ids", F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"), F.col("p.doc_id").alias("doc_ids"),
                F.col("p.offset").alias("offsets")).write.parquet(out)
