"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly, copies of a text stay together.

Rows with equal text form a group. A group stays whole unless it has more
bytes or rows than a shard's whole share; then it is cut into pieces by the
hash of its rows. Groups and pieces are packed in rounds. They are dealt by hash to
lots of about ``PER_LOT``, and in each lot, largest first, one goes to that of
the lot's bins (``FINE`` times the shards) where the dot product of its (bytes, tokens, rows)
with the bin's residual capacity is highest, each dimension measured in the
bin's capacity (an even part of the lot's total) and weighted. The next round
packs the bins of all lots in the same way, and the last one has a single lot
whose bins are the shards. Whole groups above a ``LARGE``-th of a share, fewer than
``LARGE`` times the shards by either measure, wait for that last round, where they are
large beside the bins. No task needs more memory than its lot's bins, and no
bin passes through the driver. The law that holds is ``bytes``: shard sizes
are near equal.

Rows: the size is the text's UTF-8 bytes plus 16; a null text has none, and is
a group of its own, apart from the empty text. Repeated rows each get a slot. The
slots of a shard number its rows in doc_id order (nulls first), rows of equal
id by text hash, from 0 without a gap. Columns other than the two named are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from period_etl.llm.common import ordered, ship, stored

#: Groups above this part of a shard's share wait for the last round; pieces of cut ones are about this part.
LARGE = 16
#: Groups, pieces or bins that one task packs, about.
PER_LOT = 20_000
#: Bins of a lot for each shard in all rounds but the last, so that the last one places small ones.
FINE = 8
_DIMENSIONS = ("bytes", "tokens", "rows")
#: The dimensions' weights in the dot product: bytes first, as their law must hold.
_WEIGHT = np.array([8.0, 1.0, 1.0])


class Bins:
    """Bins of equal capacity: each item goes where the dot product with what is left is highest, the first of equal ones."""

    def __init__(self, bins: int, total: np.ndarray):
        self.left = np.ones((bins, len(total)))
        self.scale = np.maximum(total / bins, 1e-9)

    def place(self, item: np.ndarray) -> int:
        size = item / self.scale
        at = int(np.argmax(self.left @ (size * _WEIGHT)))
        self.left[at] -= size
        return at


def _packed(items: DataFrame, keys: list[str], shards: int) -> DataFrame:
    """``keys``, ``lot`` and ``bin`` of each of the items (keys, lot, bytes, tokens, rows), lot by lot."""
    names = [*keys, "lot", *_DIMENSIONS]

    def run(batches):
        now, bins = None, None
        for batch in batches:
            lots = batch.column("lot").to_pylist()
            load, total = (np.stack([batch.column(p + d).to_numpy() for d in _DIMENSIONS], 1).astype(float) for p in ("", "all_"))
            out = np.zeros(len(lots), np.int32)
            for i, lot in enumerate(lots):
                if lot != now:
                    now, bins = lot, Bins(shards, total[i])
                out[i] = bins.place(load[i])
            yield pa.record_batch([*(batch.column(c) for c in names), pa.array(out)], names=[*names, "bin"])

    lot = Window.partitionBy("lot")   # about PER_LOT rows
    whole = items.withColumns({f"all_{d}": F.sum(d).over(lot) for d in _DIMENSIONS})
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.select(names).schema.fields)
    return whole.sortWithinPartitions("lot", F.desc("bytes"), F.desc("tokens"), *keys).select(*names, *(f"all_{d}" for d in _DIMENSIONS)).mapInArrow(run, f"{kinds}, bin int")


def _sums() -> list:
    return [F.sum(d).alias(d) for d in _DIMENSIONS]


def _assigned(pieces: DataFrame, large: DataFrame, count: int, shards: int, per_lot: int) -> DataFrame:
    """(t1, t2, piece, shard) for the pieces and the large groups (t1, t2, piece, bytes, tokens, rows); ``count`` bounds the pieces' number."""
    keys, bins = ["t1", "t2", "piece"], FINE * shards
    per_lot = max(per_lot, 4 * bins)   # a round leaves a quarter at most
    lots, rounds, items, ids = -(-count // per_lot), [], pieces, keys
    while lots > 1:
        dealt = items.withColumn("lot", F.pmod(F.xxhash64(*ids), F.lit(lots)).cast("int"))
        placed = stored(_packed(dealt, ids, bins), "shard-round")
        rounds.append((placed, ids))
        items = placed.groupBy("lot", "bin").agg(*_sums()).withColumnsRenamed({"lot": "l", "bin": "b"})
        ids, lots = ["l", "b"], -(-lots * bins // per_lot)
    # the last round: what is left and the large groups, told apart by which keys they have
    both = items.unionByName(large, allowMissingColumns=True) if ids != keys else items.unionByName(large)
    names = [*ids, *keys] if ids != keys else keys
    last = stored(_packed(both.withColumn("lot", F.lit(0)), names, shards).withColumn("shard", F.col("bin")), "shard-last")
    if ids == keys:
        return last.select(*keys, "shard")
    out = last.where("l is not null").select("l", "b", "shard")
    for placed, own in reversed(rounds):
        mine = placed.withColumnsRenamed({"lot": "l2", "bin": "b2"})
        out = mine.join(out.withColumnsRenamed({"l": "l2", "b": "b2"}), ["l2", "b2"]).select(*own, "shard")
    return out.unionByName(last.where("l is null").select(*keys, "shard"))


def _seats(docs: DataFrame, shards: int, id_col: str, text_col: str, per_lot: int = PER_LOT) -> DataFrame:
    """(doc_id, size, text_crc32, t1, shard, slot) for each row of ``docs``; t1 is the text's xxhash64."""
    spark = docs.sparkSession
    ship(spark)
    text = F.col(text_col)
    rows = stored(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        F.xxhash64(text).alias("t1"), F.xxhash64(text.isNull(), F.reverse(text)).alias("t2"),
        F.monotonically_increasing_id().alias("tie")), "shard-rows")
    groups = stored(rows.groupBy("t1", "t2").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")), "shard-groups")
    total = groups.agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.count("*").alias("n")).first()
    share, most = (total.bytes or 0) / shards, (total.rows or 0) / shards
    over = F.greatest(F.col("bytes") / F.lit(max(share, 1.0)), F.col("rows") / F.lit(max(most, 1.0)))
    groups = groups.withColumn("pieces", F.when(over > 1, F.ceil(over * LARGE)).cast("int"))
    # no more than 2 * shards groups are beyond a share by bytes or by rows
    cut = F.broadcast(groups.where("pieces is not null").select("t1", "t2", "pieces"))
    rows = rows.join(cut, ["t1", "t2"], "left").withColumn(
        "piece", F.when(F.col("pieces").isNotNull(), F.pmod(F.xxhash64("doc_id", "tie"), F.col("pieces"))).otherwise(F.lit(0)).cast("int")).drop("pieces")
    parts_ = rows.join(cut, ["t1", "t2"], "left_semi").groupBy("t1", "t2", "piece").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    whole = groups.where("pieces is null").select("t1", "t2", F.lit(0).alias("piece"), *_DIMENSIONS, (over * LARGE > 1).alias("large"))
    where = stored(_assigned(whole.where("not large").drop("large").unionByName(parts_), whole.where("large").drop("large"),
                             total.n, shards, per_lot), "shard-where")

    seated = rows.join(where, ["t1", "t2", "piece"]).select("doc_id", "size", "text_crc32", "t1", "shard")
    seated = stored(ordered(seated, "shard", "doc_id", "t1"), "shard-order")
    # a shard's rows stand one after the other: the slot is the place less the place of the shard's first row
    spans = sorted(seated.groupBy("_part", "shard").agg(F.min("_row").alias("first"), F.count("*").alias("n")).collect())
    before: dict[int, int] = {}
    offsets = []
    for part, number, first, count in spans:
        offsets.append((part, number, before.get(number, 0) - first))
        before[number] = before.get(number, 0) + count
    offset = F.broadcast(spark.createDataFrame(offsets, "_part int, shard int, offset long"))
    return seated.join(offset, ["_part", "shard"]).select(
        "doc_id", "size", "text_crc32", "t1", "shard", (F.col("_row") + F.col("offset")).alias("slot"))


def assign_shards(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", per_lot: int = PER_LOT) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of ``docs``."""
    return _seats(docs, shards, id_col, text_col, per_lot).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, out: str, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the rows' ids and texts as Parquet folders ``shard=0`` and so on, each row with its slot."""
    seats = _seats(docs, shards, id_col, text_col).select(F.col("doc_id").alias("_i"), "t1", "shard", "slot")
    # equal rows are told apart by their slots alone, so one of them lends its text to all
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("_t"))
    texts = texts.dropDuplicates(["doc_id", "_t"])
    same = texts["doc_id"].eqNullSafe(seats["_i"]) & (texts["_t"] == seats["t1"])
    seats.join(texts, same).select("doc_id", "text", "shard", "slot").write.partitionBy("shard").parquet(out)
