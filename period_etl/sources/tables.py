"""S4: catalog-table scan with an optional ``column = value`` filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, table: str, column: str | None = None,
               value: str | None = None) -> DataFrame:
    """All columns of ``table``; with both ``column`` and ``value`` given,
    only rows where ``column = value``. On the partition column the filter
    prunes to one directory. A missing table raises ``AnalysisException``.
    """
    df = spark.table(table)
    if column is not None and value is not None:
        df = df.filter(F.col(column) == F.lit(value))
    return df


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def attach_table(spark: SparkSession, table: str, location: str) -> DataFrame:
    """Register an existing partitioned Parquet folder as ``table``.

    The session catalog forgets tables when the session ends; the data stays.
    This re-creates the catalog entry over the folder (schema and partition
    columns taken from the files) and recovers its partitions, so a later
    session can read, append to or overwrite the same table.
    """
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING parquet LOCATION {sql_text(location)}")
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return spark.table(table)
