"""Merkle dataset manifest: a tree of digests over the rows of each group, and one over the groups' roots.

``build`` numbers the rows of each group by ``key`` and persists, of all
levels of the trees, only every ``every``-th: an aligned subtree has at most
2**every stored nodes below its stored root. ``verify`` extracts the proof of
every row from the top down: for each subtree it regenerates the missing
interior nodes from the stored ones, emits the siblings on each node's way up,
and discards them. A subtree is one small group of rows, so a group with any
share of all rows is spread over as many tasks as it has subtrees.

A node is the lowercase hex sha256 of the run of two nodes below it (hex text,
one after the other); the last run of a level may be a single node, which is
hashed again. A tree of one leaf is that leaf. The groups' roots, in the order
of their names (null first, UTF-8 bytewise), are the leaves of the last tree.

Rows: null is a group and a key like any other and comes first. Rows of equal
key stand in the order of their leaves, so repeated rows each get a place and
a proof. Texts never leave the scan: only digests are shuffled. An empty table
has no root and gives no row. The tables' columns besides the named ones keep
their names, as long as these don't begin with an underscore.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from period_etl.llm.common import ordered, ship, stored

#: Levels from one stored level to the next.
EVERY = 10
#: Spans (a group's rows in one range partition) that a join broadcasts at most; about 100 bytes each.
SPANS = 200_000
_SIGNS = str.maketrans("", "", "<>.")
_NODES = pa.schema([("_g", pa.int64()), ("_n", pa.int64()), ("_i", pa.int64()), ("_h", pa.string())])
_NODE_KINDS = "_g long, _n long, _i long, _h string"


def node(*below: str) -> str:
    """The digest of the nodes below, hex text in, hex text out."""
    return sha256("".join(below).encode()).hexdigest()


def height(leaves: int) -> int:
    """Levels above the leaves of a tree."""
    return max(0, leaves - 1).bit_length()


def leaf_digest(*values: Column) -> Column:
    """A row's leaf: the sha256 of its values, each '-' if null, else its UTF-8 bytes' number, ':' and itself."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts)).cast("binary"), 256)


def regenerated(nodes: list[str], levels: int) -> list[list[str]]:
    """A subtree's nodes, level by level, from its lowest."""
    out = [nodes]
    for _ in range(levels):
        nodes = [node(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        out.append(nodes)
    return out


def siblings(tree: list[list[str]], at: int) -> str:
    """A node's way to the top of a subtree: for each level '<' or '>' and the left or right sibling, or '.' for none."""
    out = []
    for row in tree[:-1]:
        other = at ^ 1
        out.append(("<" if at & 1 else ">") + row[other] if other < len(row) else ".")
        at >>= 1
    return "".join(out)


def fold(leaf: str, way: str) -> str:
    """The root that a leaf and the siblings on its way give."""
    at = 0
    while at < len(way):
        sign, other = way[at], way[at + 1:at + 65]
        at += 1 if sign == "." else 65
        leaf = node(leaf) if sign == "." else node(other, leaf) if sign == "<" else node(leaf, other)
    return leaf


@dataclass
class Manifest:
    """The stored levels of the groups' trees (the first has the rows) and of the tree above them, and its root."""

    levels: list[DataFrame]
    top: list[DataFrame]
    root: str | None
    every: int


def _numbered(rows: DataFrame, group: str, key: str) -> DataFrame:
    """The rows with their group's number ``_g`` and size ``_n`` and their place in it ``_i``."""
    # equal rows are told apart by where they were read, so that no range is larger than another
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    seated = stored(ordered(tied, group, key, "_h", "_tie"), "merkle-rows")
    spans = stored(seated.groupBy("_part", group).agg(F.min("_row").alias("_first"), F.count("*").alias("_size")), "merkle-spans")
    groups = stored(ordered(spans.groupBy(group).agg(F.sum("_size").alias("_n")), group), "merkle-groups")
    # one row for each range partition: their number is the session's setting
    ahead = groups.groupBy("_part").agg(F.count("*").alias("_c")).select(
        "_part", F.coalesce(F.sum("_c").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_c"))
    groups = groups.join(ahead, "_part").select(F.col(group).alias("_name"), "_n", (F.col("_row") + F.col("_c")).alias("_g"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(F.col("_part").alias("_p"), group, (F.coalesce(F.sum("_size").over(earlier), F.lit(0)) - F.col("_first")).alias("_off"))
    spans = stored(spans.join(groups, spans[group].eqNullSafe(groups["_name"])).select("_p", "_name", "_g", "_n", "_off"), "merkle-places")
    if spans.count() <= SPANS:
        spans = F.broadcast(spans)
    out = seated.join(spans, (seated["_part"] == spans["_p"]) & seated[group].eqNullSafe(spans["_name"]))
    return out.withColumn("_i", F.col("_row") + F.col("_off")).drop("_p", "_name", "_off", "_row", "_part", "_tie")


def _climbed(leaves: DataFrame, every: int) -> list[DataFrame]:
    """The stored levels above ``leaves`` (_g, _n, _i, _h), the leaves first and each group's root last."""
    levels, tallest = [leaves], height(leaves.agg(F.max("_n")).first()[0] or 0)

    def upwards(base):
        def up(key, table):
            table = table.sort_by("_i")
            size = table.column("_n")[0].as_py()
            top = regenerated(table.column("_h").to_pylist(), min(every, max(0, height(size) - base)))[-1]
            return pa.table([[key[0].as_py()], [size], [key[1].as_py()], top], schema=_NODES)

        return up

    for base in range(0, tallest, every):
        nodes = levels[-1].select("_g", "_n", "_i", "_h", F.shiftright("_i", every).alias("_b"))
        levels.append(stored(nodes.groupBy("_g", "_b").applyInArrow(upwards(base), _NODE_KINDS), "merkle-level"))
    return levels


def _ways(levels: list[DataFrame], above: DataFrame, every: int, last, kinds: str) -> DataFrame:
    """Ways from the lowest level to the root, from the top down; ``above`` (_g, _way, ...) has the ways of the groups' roots.

    ``last`` (table of a subtree's nodes, their ways, the row above) makes the
    result's table of the lowest level, whose columns are ``kinds``.
    """
    rest = [f for f in above.schema.fields if f.name != "_g"]
    over = above.withColumn("_i", F.lit(0).cast("long"))
    shape = "_g long, _i long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rest)

    def downwards(j):
        def down(key, mine, own):
            mine = mine.sort_by("_i")
            size, at = mine.column("_n")[0].as_py(), mine.column("_i").to_pylist()
            tree = regenerated(mine.column("_h").to_pylist(), min(every, max(0, height(size) - j * every)))
            ways = [siblings(tree, i & (1 << every) - 1) + own.column("_way")[0].as_py() for i in at]
            if not j:
                return last(mine, ways, own)
            same = {f.name: [own.column(f.name)[0].as_py()] * len(at) for f in rest}
            return pa.table({"_g": mine.column("_g"), "_i": mine.column("_i"), **same, "_way": ways},
                            schema=pa.schema([("_g", pa.int64()), ("_i", pa.int64()), *((f.name, pa.string()) for f in rest)]))

        return down

    for j in range(len(levels) - 2, -1, -1):
        nodes = levels[j].withColumn("_b", F.shiftright("_i", every))
        over = nodes.groupBy("_g", "_b").cogroup(over.withColumnRenamed("_i", "_b").groupBy("_g", "_b")).applyInArrow(downwards(j), shape if j else kinds)
        if j:
            over = stored(over, "merkle-ways")
    if len(levels) == 1:   # trees of one leaf each
        over = levels[0].groupBy("_g").cogroup(over.groupBy("_g")).applyInArrow(
            lambda key, mine, own: last(mine, own.column("_way").to_pylist() * mine.num_rows, own), kinds)
    return over


def build(rows: DataFrame, group: str, key: str, leaf: str, every: int = EVERY) -> Manifest:
    """The manifest of ``rows``: a tree for each value of ``group`` with the digests ``leaf`` in the order of ``key``."""
    ship(rows.sparkSession)
    numbered = stored(_numbered(rows.withColumn("_h", F.col(leaf)), group, key), "merkle-leaves")
    levels = _climbed(numbered, every)
    count = numbered.agg(F.max("_g")).first()[0]
    top = _climbed(levels[-1].select(F.lit(0).cast("long").alias("_g"), F.lit((count or 0) + 1).cast("long").alias("_n"), F.col("_g").alias("_i"), "_h"), every)
    root = top[-1].select("_h").first()
    return Manifest(levels, top, root[0] if root else None, every)


def verify(manifest: Manifest, claim: str, ways: bool = False) -> DataFrame:
    """The manifest's rows with ``subroot``, ``root``, ``proof_sha256`` (of the siblings' hex text, from the leaf
    to the root), ``folded_root`` (what ``claim`` and these siblings give) and ``verified``; with ``ways`` also ``proof``."""
    root, keep = manifest.root, [f for f in manifest.levels[0].schema.fields if not f.name.startswith("_")]
    start = manifest.top[-1].select("_g", F.lit("").alias("_way"))

    def named(mine, ways_, own):
        return pa.table([mine.column("_i"), pa.array(ways_, pa.string()), mine.column("_h")], names=["_g", "_way", "_root"])

    above = stored(_ways(manifest.top, start, manifest.every, named, "_g long, _way string, _root string"), "merkle-ways")

    def proved(mine, ways_, own):
        folded = [fold(c, w) for c, w in zip(mine.column(claim).to_pylist(), ways_, strict=True)]
        plain = [w.translate(_SIGNS) for w in ways_]
        n = len(folded)
        columns = {f.name: mine.column(f.name) for f in keep} | {
            "subroot": pa.array([own.column("_root")[0].as_py()] * n, pa.string()), "root": pa.array([root] * n, pa.string()),
            "proof_sha256": pa.array([node(p) for p in plain], pa.string()), "folded_root": pa.array(folded, pa.string()),
            "verified": pa.array([f == root for f in folded], pa.bool_())}
        if ways:
            columns["proof"] = pa.array([[p[i:i + 64] for i in range(0, len(p), 64)] for p in plain], pa.list_(pa.string()))
        return pa.table(columns)

    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep), "subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
                       *["proof array<string>"] * ways])
    return _ways(manifest.levels, above, manifest.every, proved, kinds)


def document_leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, claim) of documents; where 7 divides crc32(doc_id as text), the claim has one more in n_chars."""
    before = F.col("doc_id"), F.col("source"), F.col("lang")
    leaf = leaf_digest(*before, F.col("n_chars"), F.col("text"))
    changed = leaf_digest(*before, F.try_add(F.col("n_chars").cast("long"), F.lit(1)), F.col("text"))
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return docs.select("doc_id", "lang", leaf.alias("leaf"), F.when(tampered, changed).otherwise(leaf).alias("claim"))
