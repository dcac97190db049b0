"""MinHash near-duplicate groups: one-permutation hashing, optimal densification, banded buckets, star edges.

Each distinct shingle set gets one signature: its shingles' hashes fall into
``bands * rows`` bins, a bin keeps its least hash, and an empty bin copies the
bin that a fixed random probe sequence of its own meets first (optimal
densification). Sets whose ``rows`` bins of a band agree share a bucket. In a
bucket all members are paired with hubs only, never with each other; links are
confirmed on the full sets. A hub is the member with the most mates in all its
buckets, the likely original of a group of copies: such a group costs one pair
a member. Members of a bucket that are not in one component by then are compared
by an exact way: buckets of nodes that share one of their least frequent
shingles (prefix filter with places) go on with further hubs outside of their
largest component, until all their members are of one component. So no link
between bucket mates is lost, and copies that have grown too far apart cost
few pairs.

At the default 32 bands of 5 rows, a pair at similarity 0.8 shares no bucket
with probability (1 - 0.8**5)**32 = 3e-6.

Rows: texts are words split at ASCII white space, A-Z in lower case. Null,
empty and word-free texts have an empty set, link with nothing and are their
own component. Every row is a document of its own, also where rows repeat a
doc_id: its component is the smallest doc_id of its group, null if the group
has none, and it is kept if that is its own doc_id. Columns other than the two
named are not read, so clashing names do no harm. No row is dropped.

A set is named by a 64-bit fingerprint of its shingles; two different sets
share one with a probability of 2**-64.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from period_etl.llm import textnp
from period_etl.llm.common import components, ship, stored
from period_etl.llm.textnp import U64, mix
from period_etl.session import unique_name

BANDS, ROWS = 32, 5
#: Hubs of a bucket in the second round, and how many times more there are in each round after it.
HUBS = 256


def _probes(bins: int, rounds: int) -> np.ndarray:
    """probe[j, i]: the bin that the empty bin i looks into at its j-th try."""
    j, i = np.meshgrid(np.arange(rounds, dtype=U64), np.arange(bins, dtype=U64), indexing="ij")
    return (mix(mix(i + U64(1)) + j * U64(0x632BE59BD9B4E019)) >> U64(33)).astype(np.int64) % bins


def signatures(doc: np.ndarray, shingle: np.ndarray, n: int, bins: int) -> np.ndarray:
    """n x bins signature values; rows of texts without shingles hold no meaning."""
    h = mix(shingle ^ U64(0xA0761D6478BD642F))
    full = np.full(n * bins, ~U64(0))
    np.minimum.at(full, doc * bins + ((h >> U64(32)) * U64(bins) >> U64(32)).astype(np.int64), h)
    full = full.reshape(n, bins)
    empty = full == ~U64(0)
    out, some = full.copy(), np.bincount(doc, minlength=n) > 0
    probe, j = _probes(bins, 64), 0
    row, col = np.nonzero(empty & some[:, None])
    while len(row):
        if j == len(probe):
            probe = _probes(bins, 2 * j)
        got = full[row, probe[j, col]]
        hit = got != ~U64(0)
        out[row[hit], col[hit]] = got[hit]
        row, col, j = row[~hit], col[~hit], j + 1
    return out


def _distinct(column: pa.Array, k: int):
    """(text index, hash) of each text's distinct shingles, in order, and each text's set fingerprint."""
    doc, sh = textnp.shingles(textnp.words(column), k)
    order = np.lexsort((sh, doc))
    doc, sh = doc[order], sh[order]
    new = np.ones(len(sh), bool)
    new[1:] = (sh[1:] != sh[:-1]) | (doc[1:] != doc[:-1])
    doc, sh = doc[new], sh[new]
    name = np.zeros(len(column), U64)
    np.add.at(name, doc, mix(sh + U64(1)))
    return doc, sh, name


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    edge = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edge), pa.array(values.view(np.int64)))


def _signed(k: int, bands: int, rows: int):
    def run(batches):
        for batch in batches:
            text = textnp.strings(batch.column("text"))
            for lo, hi in textnp.chunks(text):
                n = hi - lo
                doc, sh, name = _distinct(text.slice(lo, n), k)
                sig = signatures(doc, sh, n, bands * rows).reshape(n, bands, rows)
                key = np.zeros((n, bands), U64) + np.arange(1, bands + 1, dtype=U64)
                for r in range(rows):
                    key = mix(key * U64(0x9E3779B97F4A7C15) + sig[:, :, r])
                size = np.bincount(doc, minlength=n)
                yield pa.record_batch([
                    *(batch.column(c).slice(lo, n) for c in ("id", "fetch", "t")), pa.array(size, pa.int64()),
                    pa.array(name.view(np.int64)), _lists(key[size > 0].ravel(), np.where(size > 0, bands, 0)),
                ], names=["id", "fetch", "t", "n", "node", "bands"])
    return run


def _sets(k: int):
    def run(batches):
        for batch in batches:
            text = textnp.strings(batch.column("text"))
            for lo, hi in textnp.chunks(text):
                doc, sh, name = _distinct(text.slice(lo, hi - lo), k)
                yield pa.record_batch([pa.array(name.view(np.int64)), _lists(sh, np.bincount(doc, minlength=hi - lo))],
                                      names=["node", "set"])
    return run


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= percent * union."""
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b"))
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    return (both.select("a", "b", common.alias("i"), (F.size("sa") + F.size("sb") - common).alias("u"))
            .where(F.col("i") * 100 >= F.col("u") * percent).select("a", "b"))


def _with_hubs(members: DataFrame, more: int) -> DataFrame:
    """The members with their next hubs: about ``more`` in each bucket, none of them of its largest component."""
    members = stored(members, "near-open")
    each = members.groupBy("key", "c").agg(F.count("*").alias("m"))
    major = stored(each.groupBy("key").agg(F.max_by("c", F.struct("m", "c")).alias("major"), (F.sum("m") - F.max("m")).alias("minor")), "near-major")
    hub = (F.col("c") != F.col("major")) & (F.pmod(F.xxhash64("key", "node", F.lit(more)), F.col("minor")) < more)
    return stored(members.join(major, "key").withColumn("hub", hub).drop("major", "minor"), "near-members")


def _crowds(members: DataFrame, percent: int) -> DataFrame:
    """The members (key, node, n, c, at) of buckets with two nodes of like size, and m, their bucket's members.

    Linked sets differ in size by a quarter at most (at 80 percent), so a
    bucket is cut into overlapping classes of size.
    """
    size = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent + 0.01))
    members = (members.withColumn("class", F.explode(F.array(size, size + 1)))
               .select(F.xxhash64("key", "class").alias("key"), "node", "n", "c", "at"))
    crowd = stored(members.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "near-crowds")
    return stored(members.join(crowd, "key"), "near-crowded")


def _prefixes(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(key, node, n, c, at): the nodes' least frequent shingles, as many as a linked set must share one of, and their places.

    Two sets with 100 * intersection >= percent * union share one of the first
    n - ceil(percent / 100 * n) + 1 shingles of each, in any common order. If
    the first that they share stands at places i and j (from 0), they share
    min(n - i, m - j) at most.
    """
    each = stored(sets.join(nodes, "node").dropDuplicates(["node"]).select("node", "n", "c", F.explode("set").alias("key")), "near-shingles")
    often = stored(each.groupBy("key").agg(F.count("*").alias("df")), "near-often")
    length = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    first = (each.join(often, "key").groupBy("node").agg(F.first("n").alias("n"), F.first("c").alias("c"), F.sort_array(F.collect_list(F.struct("df", "key"))).alias("all"))
             .select("node", "n", "c", F.posexplode(F.slice("all", F.lit(1), length.cast("int"))).alias("at", "g")))
    return first.where("g.df > 1").select(F.col("g.key").alias("key"), "node", "n", "c", "at")


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80,
            bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, t, n, c, component) for each row: its id, its text's xxhash64, its set's size, the name of its group (null
    without words) and the group's smallest id."""
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = texts.withColumn("t", F.xxhash64("text")).select("id", F.coalesce("id", "t").alias("fetch"), "t", "text")
    signed = stored(texts.mapInArrow(_signed(k, bands, rows), "id long, fetch long, t long, n long, node long, bands array<long>"), "near-sign")
    nodes = stored(signed.where("n > 0").groupBy("node").agg(
        F.min("id").alias("id"), F.min("fetch").alias("fetch"), F.min("n").alias("n"), F.first("bands").alias("bands")), "near-nodes")

    banded = nodes.select(F.explode("bands").alias("key"), "node", "n")
    shared = stored(banded.groupBy("key").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x != y").select("key"), "near-keys")
    members = _crowds(stored(banded.join(shared, "key").select("key", "node", "n", F.col("node").alias("c"), F.lit(0).alias("at")), "near-mates"), percent)
    # the node with the most mates over all its buckets is the likely original of a group: it is the first hub
    mates = stored(members.groupBy("node").agg(F.sum("m").alias("mates")), "near-mates")
    members = stored(members.drop("m").join(mates, "node"), "near-open")
    top = stored(members.groupBy("key").agg(F.max(F.struct("mates", "node")).alias("top")).select("key", F.col("top.node").alias("top")), "near-top")
    members = stored(members.join(top, "key").withColumn("hub", F.col("node") == F.col("top")).drop("top", "mates"), "near-members")
    asked = members.select("node").distinct().join(nodes.select("node", "fetch"), "node").select("fetch").distinct()
    found = texts.join(asked, "fetch").dropDuplicates(["fetch", "t"])
    sets = stored(found.select("text").mapInArrow(_sets(k), "node long, set array<long>"), "near-sets")

    links = tested = None
    more = 0
    while True:
        hub = members.where("hub").select("key", F.col("node").alias("h"), F.col("n").alias("hn"), F.col("c").alias("hc"), F.col("at").alias("hat"))
        room = F.least(F.col("n") - F.col("at"), F.col("hn") - F.col("hat"))  # what the two can share at most
        pairs = (members.join(hub, "key").where("node != h and c != hc")
                 .where(room * (100 + percent) >= (F.col("n") + F.col("hn")) * percent)
                 .select(F.least("node", "h").alias("a"), F.greatest("node", "h").alias("b")).distinct())
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "near-pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = stored(_linked(pairs, sets, percent), "near-links")
        if links is None or not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            labels = components(links, label="near-labels")
        # a bucket goes on without the hubs it had, while it holds two components
        rest = stored(members.where("not hub").select("key", "node", "n", "at").join(labels.withColumnRenamed("id", "node"), "node", "left")
                      .select("key", "node", "n", "at", F.coalesce("component", "node").alias("c")), "near-rest")
        split = stored(rest.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 != c1").select("key"), "near-split")
        if split.isEmpty():
            break
        open_ = rest.join(split, "key")
        if not more:
            open_ = _crowds(stored(_prefixes(stored(open_.select("node", "n", "c").distinct(), "near-open"), sets, percent), "near-prefixes"), percent).drop("m")
        more = more * HUBS or HUBS
        members = _with_hubs(open_, more)

    group = nodes.select("node", "id").join(labels.withColumnRenamed("id", "node"), "node", "left").select(
        "node", "id", F.coalesce("component", "node").alias("c"))
    least = stored(group.groupBy("c").agg(F.min("id").alias("component")), "near-least")
    named = stored(group.join(least, "c").select("node", "c", "component"), "near-named")
    return (signed.where("n > 0").select("id", "t", "n", "node").join(named, "node").select("id", "t", "n", "c", "component")
            .unionByName(signed.where("n = 0").select("id", "t", "n", F.lit(None).cast("long").alias("c"), F.col("id").alias("component"))))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``; see the module."""
    out = grouped(docs, id_col, text_col, **settings)
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
                      F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` with one row left of each group: that of the smallest id (of equals, of the least text
    hash; of equal rows, any). Rows without words stay."""
    out = stored(grouped(docs, id_col, text_col, **settings), "near-groups")
    first = F.min(F.struct(F.coalesce("id", F.lit((1 << 63) - 1)), "t", "id"))
    # names that no column of docs has
    key, hash_, id_, t = (unique_name("near") for _ in range(4))
    stay = stored(out.where("c is not null").groupBy("c").agg(first.alias("s")).select(F.col("s.id").alias(id_), F.col("s.t").alias(t)), "near-stay")
    keyed = docs.withColumns({key: F.col(id_col).cast("long"), hash_: F.xxhash64(text_col)})
    blank = ~F.coalesce(text_col, F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    one = keyed.where(~blank).join(stay, F.col(hash_).eqNullSafe(F.col(t)) & F.col(key).eqNullSafe(F.col(id_)), "left_semi")
    return one.dropDuplicates([key, hash_]).unionByName(keyed.where(blank)).drop(key, hash_)
