"""Stage rows kept by micro-batch: each batch is a partition of its own, so a replay replaces itself.

A batch is named by the epochs that it covers (``000000007-000000007``). Its
rows of a period are stored under ``period=../batch=..``. Compaction writes the
rows of several batches under one name that covers them all; a reader leaves
out every batch whose epochs lie within another one's, so it sees each row once
before, while and after the covered batches are deleted.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from period_etl.fixed import DATE, PERIOD, TOTAL

BATCH = "batch"


def batch_name(first: int, last: int | None = None) -> str:
    return f"{first:09d}-{first if last is None else last:09d}"


def batch_span(name: str) -> tuple[int, int]:
    first, last = name.split("-")
    return int(first), int(last)


def covered(names: Iterable[str]) -> set[str]:
    """The batches whose epochs lie within another batch's."""
    out, reach = set(), -1
    for first, last, name in sorted(((*batch_span(n), n) for n in set(names)), key=lambda s: (s[0], -s[1])):
        if last <= reach:
            out.add(name)
        reach = max(reach, last)
    return out


def live(df: DataFrame, stored: Mapping[str, Iterable[str]]) -> DataFrame:
    """The rows of batches that no other batch covers; ``stored`` are the batches of each period."""
    gone = [(period, name) for period, names in stored.items() for name in sorted(covered(names))]
    if not gone:
        return df
    return df.filter(~reduce(lambda a, b: a | b, ((F.col(PERIOD) == p) & (F.col(BATCH) == n) for p, n in gone)))


def summed(partials: DataFrame) -> DataFrame:
    """Daily counts of all batches together, from each batch's own."""
    return partials.groupBy(DATE, PERIOD).agg(F.sum(TOTAL).alias(TOTAL))
