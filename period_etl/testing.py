"""Fixture builders for queries, tests and the benchmark (not library API).

``make_landing`` turns one table into a landing set in a single
partitioned write: each row goes to the entry named
``{prefix}_{YYYY-MM of (ts + 1 day)}``, so the last day of every month lands
in the next month's entry and must be cleaned away.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shifted_period(ts: F.Column, days: int = 1) -> F.Column:
    shifted = F.date_add(F.to_date(ts), days)
    return F.concat(F.lpad(F.year(shifted).cast("string"), 4, "0"), F.lit("-"),
                    F.lpad(F.month(shifted).cast("string"), 2, "0"))


def make_landing(df: DataFrame, ts_col: str, root: str, prefix: str) -> str:
    """Write ``df`` as landing entries ``root/entry={prefix}_{YYYY-MM}/``."""
    entry = F.concat(F.lit(prefix + "_"), shifted_period(F.col(ts_col)))
    df.withColumn("entry", entry).write.partitionBy("entry").parquet(root)
    return root
