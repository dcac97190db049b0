"""Parquet scans: whole dataset (S1) and period-partitioned dataset (S3)."""

from __future__ import annotations

import re
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from period_etl.fixed import PERIOD
from period_etl.sources.schemas import footer_columns, merge_failed, resolve


def scan_parquet(spark: SparkSession, path: str, *more: str,
                 schema: StructType | None = None, **options: str) -> DataFrame:
    """S1: lazy scan of one or more Parquet paths, all columns (P3).

    Nothing is read here; Catalyst prunes columns and pushes filters into the
    scan when the frame is used.
    """
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path, *more)


def _as_list(periods: str | Iterable[str] | None) -> list[str] | None:
    if periods is None:
        return None
    if isinstance(periods, str):
        return [periods]
    return list(periods)


def key_filter(df: DataFrame, key: str, values: str | Iterable[str] | None) -> DataFrame:
    """``key = value`` (one value) or ``key IN (...)``; None keeps all rows."""
    vals = _as_list(values)
    if vals is None:
        return df
    if len(vals) == 1:
        return df.filter(F.col(key) == F.lit(vals[0]))
    return df.filter(F.col(key).isin(vals))


def partition_values(spark: SparkSession, path: str, key: str) -> dict[str, str] | None:
    """``{value: directory}`` of the ``key=value`` folders directly under ``path``.

    One directory listing on the driver (names only, one per period), or
    None when it cannot be listed here.
    """
    try:
        sc = spark.sparkContext
        hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
        fs = hpath.getFileSystem(sc._jsc.hadoopConfiguration())
        if not fs.exists(hpath):
            return {}
        out = {}
        for status in fs.listStatus(hpath):
            name = status.getPath().getName()
            if status.isDirectory() and name.startswith(key + "="):
                out[unquote(name[len(key) + 1:])] = name
        return out
    except Exception:  # pragma: no cover - remote session
        return None


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a stored folder through the Hadoop file system; a missing one is fine."""
    sc = spark.sparkContext
    hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(sc._jsc.hadoopConfiguration()).delete(hpath, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    sc = spark.sparkContext
    hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(sc._jsc.hadoopConfiguration()).exists(hpath)


def literal_path(path: str) -> str:
    """The path with characters escaped that a reader would expand as a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _string_key(df: DataFrame, key: str) -> DataFrame:
    if key in df.columns and not isinstance(df.schema[key].dataType, StringType):
        return df.withColumn(key, F.col(key).cast("string"))
    return df


def _merged_scan(spark: SparkSession, paths: list[str], options: dict, key: str) -> DataFrame:
    """A scan with the schemas of all footers merged; types that differ are widened where that is exact."""
    try:
        return scan_parquet(spark, *paths, **options)
    except Exception as exc:
        if not merge_failed(exc):
            raise
    base = options.get("basePath", paths[0])
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    found = footer_columns(spark, [hpath(p).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hpath(p)).toString() for p in paths])
    schema, _ = resolve(found, paths)
    if key not in schema.names and base not in paths:
        schema = StructType(schema.fields).add(key, "string")
    return scan_parquet(spark, *paths, schema=schema, **options)


def read_partitioned(spark: SparkSession, path: str, key: str = PERIOD,
                     periods: str | Iterable[str] | None = None,
                     schema: StructType | None = None, **options: str) -> DataFrame:
    """S3: scan a hive-style dataset, keeping only the given key values.

    With ``periods`` given, only those ``key=value`` folders are listed and
    read (``basePath`` keeps ``key`` as a column), so the cost of a run's
    read follows the run, not the dataset's history; the equality (or IN)
    filter still shows as ``PartitionFilters``. A key Spark inferred as a
    number is read back as a string, the only legal key type. Periods may
    have been stored with different columns: their schemas are merged from
    the footers (``mergeSchema="false"`` in ``options`` trusts one footer), a
    missing column reads as null, and types that differ are widened where that
    changes no value.
    """
    wanted = _as_list(periods)
    if schema is None:
        options = {"mergeSchema": "true", **options}

    def scan(*paths: str, **more: str) -> DataFrame:
        if schema is None:
            return _merged_scan(spark, list(paths), {**options, **more}, key)
        return scan_parquet(spark, *paths, schema=schema, **options, **more)

    if wanted is None:
        return _string_key(scan(path), key)
    folders = partition_values(spark, path, key)
    if folders:
        hits = [folders[v] for v in dict.fromkeys(wanted) if v in folders]
        if hits:
            base = path.rstrip("/")
            df = scan(*[f"{base}/{h}" for h in hits], basePath=base)
            return key_filter(_string_key(df, key), key, wanted)
    # Nothing to narrow to (or not listable): the pruned scan of the whole
    # dataset gives the same rows, an empty frame when none match.
    return key_filter(_string_key(scan(path), key), key, wanted)


def stored_values(spark: SparkSession, path: str, key: str = PERIOD) -> list[str] | None:
    """Key values present in a hive-style dataset (sorted), None if unknown."""
    folders = partition_values(spark, path, key)
    return None if folders is None else sorted(folders)
