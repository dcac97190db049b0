"""Clean: keep the rows whose timestamp lies in their period's month.

F1/F3/P1 for one known period and the one-pass form for a landing frame
whose rows carry their own period (L2's transform).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from period_etl.fixed import PERIOD
from period_etl.functions.periods import month_key_col, parse_period, period_key_col


def _month_bounds(dtype, year: int, month: int) -> tuple[Column, Column] | None:
    """First instant of the month and of the next one, typed like the column."""
    if not (1 <= month <= 12 and 1 <= year <= 9998):
        return None
    ny, nm = (year + 1, 1) if month == 12 else (year, month + 1)
    if isinstance(dtype, TimestampNTZType):
        make = lambda y, m: F.make_timestamp_ntz(F.lit(y), F.lit(m), F.lit(1),
                                                 F.lit(0), F.lit(0), F.lit(0))
    elif isinstance(dtype, TimestampType):
        # Session time zone, the same zone year()/month() use.
        make = lambda y, m: F.make_timestamp(F.lit(y), F.lit(m), F.lit(1),
                                             F.lit(0), F.lit(0), F.lit(0))
    elif isinstance(dtype, DateType):
        make = lambda y, m: F.make_date(F.lit(y), F.lit(m), F.lit(1))
    else:
        return None
    return make(year, month), make(ny, nm)


def in_month(df: DataFrame, ts_col: str, year: int, month: int) -> Column:
    """F1 + F3: ``year(ts) = year AND month(ts) = month`` (null is no match).

    For a real month on a timestamp or date column the same predicate is
    written as a half-open range of two constants: two comparisons per row
    instead of two calendar conversions, and Parquet min/max statistics can
    skip whole row groups. Any other month (``00``, ``13``) keeps the plain
    form, which matches no row.
    """
    ts = F.col(ts_col)
    bounds = _month_bounds(df.select(ts_col).schema[0].dataType, year, month)
    if bounds is None:
        return (F.year(ts) == F.lit(year)) & (F.month(ts) == F.lit(month))
    lo, hi = bounds
    return (ts >= lo) & (ts < hi)


def filter_by_period(df: DataFrame, period: str, ts_col: str) -> DataFrame:
    """F1 + P1 + P7: rows of month ``period`` plus a constant ``period`` column."""
    year, month = parse_period(period)
    return df.filter(in_month(df, ts_col, year, month)).withColumn(PERIOD, F.lit(period))


def clean_tagged(df: DataFrame, ts_col: str, period_col: str = PERIOD) -> DataFrame:
    """L2 transform: keep rows whose own month equals their row's period.

    ``df`` carries a well-formed ``YYYY-MM`` period per row (from the landing
    scan), so one pass cleans every period at once; the comparison is a
    single integer test, ``year*100+month = int(replace(period,'-',''))``.
    """
    keep = month_key_col(F.col(ts_col)) == period_key_col(F.col(period_col))
    return df.filter(keep)
