"""Analytics: per-day row counts per period (P2, P4, P9, A1) and load counts (A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from period_etl.fixed import DATE, PERIOD, TOTAL

def with_date(df: DataFrame, ts_col: str, name: str = DATE) -> DataFrame:
    """P2 + P9: add the calendar date of ``ts_col``, keep all other columns."""
    return df.withColumns({name: F.to_date(F.col(ts_col))})


def daily_counts(df: DataFrame, ts_col: str, key: str = PERIOD,
                 with_row_counts: bool = False) -> DataFrame:
    """A1: ``(date, period, total_trips)``, one row per day and period.

    ``total_trips`` counts non-null dates (a null-date group gets 0, not its
    row number) and is a bigint (P4). Spark plans a partial aggregate before
    the one hash exchange, so a day holding a third of all rows is folded to
    one row per task before anything moves; the output is bounded by the
    number of calendar days, not by the data. ``with_row_counts`` adds
    ``n_rows``, all rows of the group (nulls included), from the same pass.
    """
    dated = with_date(df.select(ts_col, key), ts_col)
    aggs = [F.count(DATE).cast("bigint").alias(TOTAL)]
    if with_row_counts:
        aggs.append(F.count(F.lit(1)).alias("n_rows"))
    return dated.groupBy(DATE, key).agg(*aggs).select(
        DATE, key, TOTAL, *(["n_rows"] if with_row_counts else []))


def load_counts(df: DataFrame, key: str = PERIOD) -> DataFrame:
    """A2: rows loaded per period, ``(period, n_rows)``.

    Counting rows reads no column data from a Parquet scan (row-group counts
    only) and aggregates partially before the exchange.
    """
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
