"""Word shingles and anchored windows in DataFrame expressions (no Python code on the executors).

An anchor is a place where a document has a shingle that some reference text
(benchmark item, licence template) has too. A window at a similarity or
containment above zero holds an anchor, so looking only at windows around
anchors loses nothing (windows that stick out of the text are moved into it),
and documents without one are done after one pass that shuffles nothing.
A reference of fewer than k words is one shingle of its whole sequence: it
matches only texts that consist of it, and is not found inside longer ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Reference rows of up to four numbers are broadcast up to this many (about 100 MB); more are joined by a shuffle.
BROADCAST_SHINGLES = 2_000_000
_BLANKS = " \t\n\x0b\x0c\r"


def word_array(text: Column, between: str = "") -> Column:
    """The words of a text in lower case, split at ASCII white space, or at matches of ``between``; none for a
    null text or one without words."""
    plain = F.lower(F.coalesce(text, F.lit("")))
    if between:
        return F.filter(F.split(plain, between), lambda w: w != "")
    plain = F.btrim(plain, F.lit(_BLANKS))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, r"[\x20\x09-\x0D]+"))


def shingle_array(words: Column, k: int) -> Column:
    """A hash for each k-word shingle, in order; fewer words give their whole sequence as one, none give none.

    ``words`` is a column of a frame, not an expression: it is read once for each word.
    """
    n = F.size(words)
    return (F.when(n == 0, F.array().cast("array<bigint>"))
            .when(n <= k, F.array(F.xxhash64(words)))
            .otherwise(F.transform(F.sequence(F.lit(1), n - (k - 1)), lambda i: F.xxhash64(F.slice(words, i, k)))))


def bounded(small: DataFrame, limit: int = BROADCAST_SHINGLES, weight: Column | None = None) -> DataFrame:
    """The frame, marked for a broadcast if it has ``limit`` rows at most, or rows of ``limit`` times four numbers in all,
    ``weight`` in each."""
    if weight is None:
        return F.broadcast(small) if small.limit(limit + 1).count() <= limit else small
    return F.broadcast(small) if (small.agg(F.sum(weight)).first()[0] or 0) <= 4 * limit else small


def anchors(keyed: DataFrame, shingles: DataFrame, k: int) -> DataFrame:
    """(keys, pos, columns of ``shingles``) for each place of ``keyed`` (columns: keys and ``words``) with a
    hash of ``shingles`` (column ``g``)."""
    keys = [c for c in keyed.columns if c != "words"]
    at = keyed.select(*keys, F.posexplode(shingle_array(F.col("words"), k)).alias("pos", "g"))
    return at.join(bounded(shingles), "g").drop("g")


def bit_sum(hashes: Column, bits: int = 64) -> Column:
    """SimHash of an array of hashes: bit i is set where more than half of the hashes have it set."""
    half = F.size(hashes) / 2
    out = F.lit(0).cast("bigint")
    for i in range(bits):
        out = out.bitwiseOR(F.when(_ones(hashes, F.lit(i)) > half, F.shiftleft(F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint")))
    return out


def _ones(hashes: Column, place: Column) -> Column:
    return F.aggregate(hashes, F.lit(0), lambda s, h: s + F.getbit(h, place).cast("int"))
