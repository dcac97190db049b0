"""Sinks: partitioned Parquet dataset (K1) and catalog table (K2-K8).

Write modes
-----------
``append``               add rows; a rerun duplicates them (the reference's
                         only table mode).
``overwrite_partitions`` replace only the key values present in the input
                         (dynamic partition overwrite); a rerun is idempotent
                         and other periods are untouched.
``overwrite``            replace the whole dataset (paths only).
``swap_partitions``      as ``overwrite_partitions``, for tables with a folder of
                         their own: the rows go to a run folder first, then the
                         catalog points each period to it. A period has its old
                         rows or its new ones, never some of each or none; a
                         write that dies leaves the old ones.

A caller that knows which key values a write should have covered passes the
report's ``keys`` and those values to ``drop_keys``: values that the input no
longer has lose their stored rows too.

No sink shuffles by default. A clean frame arrives from a scan whose tasks
each read one landing entry, i.e. one period, so every task writes one file
into one period directory: file count follows input splits, and a hot period
is spread over as many tasks as it has splits. No sink sorts by the key either,
unless rows are wanted in order: a task keeps a file open for each of its first
OPEN_FILES keys and sorts only what other keys it meets, so a task of one period
holds no rows, however many it reads. ``rebalance=True`` adds one
``REBALANCE(key)`` exchange for inputs whose tasks mix many keys; with AQE on,
Spark splits skewed keys and merges small ones there.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Sequence
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from period_etl.fixed import PERIOD
from period_etl.sources.parquet import delete_folder, literal_path, partition_values
from period_etl.sources.tables import sql_text

MODES = ("append", "overwrite_partitions", "overwrite")
#: Files that a task keeps open, one for each key; each holds a row group of its own in memory.
OPEN_FILES = 4


@dataclass
class WriteReport:
    """What a write did; rows, keys and dropped null keys are read from observed metrics."""

    target: str
    written: bool = True
    _observation: Observation | None = field(default=None, repr=False)

    def _observed(self, name: str, empty):
        if not self.written or self._observation is None:
            return empty
        return self._observation.get.get(name) or empty

    @property
    def dropped_null_keys(self) -> int:
        return int(self._observed("dropped_null_keys", 0))

    @property
    def rows(self) -> int:
        return int(self._observed("rows", 0))

    @property
    def keys(self) -> list[str]:
        """The key values written (one per period)."""
        return sorted(k for k in self._observed("keys", []) if k is not None)


def check_key(df: DataFrame, key: str) -> None:
    """K6: the partition key must exist and be a string column."""
    if key not in df.columns:
        raise ValueError(f"partition column {key!r} not found in {df.columns}")
    dtype = df.schema[key].dataType
    if not isinstance(dtype, StringType):
        raise ValueError(f"partition column {key!r} must be a string, got {dtype.simpleString()}")


def drop_null_keys(df: DataFrame, key: str) -> tuple[DataFrame, Observation]:
    """K5: rows with a null key are dropped; their number is observed.

    The counts ride along the write as observed metrics: no second pass. They
    are taken in the stage that writes, whose tasks count once each, so apply
    this after a rebalance.
    """
    obs = Observation()
    null = F.col(key).isNull()
    counted = df.observe(obs, F.count_if(null).alias("dropped_null_keys"), F.count_if(~null).alias("rows"),
                         F.collect_set(key).alias("keys"))
    return counted.filter(F.col(key).isNotNull()), obs


def _prepare(df: DataFrame, key: str, rebalance: bool, order_by: Sequence[str]) -> DataFrame:
    df = df.hint("rebalance", key) if rebalance else df
    # the writer needs rows by key anyway; sorted like this it adds no sort of its own
    return df.sortWithinPartitions(key, *order_by).drop(*order_by) if order_by else df


def _writer(df: DataFrame, key: str, mode: str, max_records_per_file: int | None):
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    w = df.write.format("parquet").partitionBy(key)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    if mode == "append":
        return w.mode("append")
    if mode == "overwrite_partitions":
        return w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    return w.mode("overwrite").option("partitionOverwriteMode", "static")


def file_sizes(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """(path, length) of the files under some folders or tables' folders: a listing, no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([literal_path(p) for p in paths])
    return files.select("path", "length")


def rows_for_bytes(spark: SparkSession, paths: Iterable[str], max_bytes: int) -> int:
    """K7 in bytes: rows that a file of ``max_bytes`` holds, by the bytes a row that Parquet files under ``paths`` take.

    Lengths come from a listing and row counts from footers. The file with the
    longest rows decides, of those with a tenth of the longest file's bytes at least
    (a short file is mostly footer).
    """
    paths = list(paths)
    sizes = file_sizes(spark, paths)
    counts = spark.read.option("recursiveFileLookup", "true").parquet(*map(literal_path, paths)).groupBy(
        F.url_decode(F.col("_metadata.file_path")).alias("path")).agg(F.count(F.lit(1)).alias("rows"))
    known = sizes.withColumn("path", F.url_decode("path")).join(counts, "path").where("rows > 0")
    longest = known.agg(F.max("length")).first()[0]
    if not longest:
        return 0
    per_row = known.where(F.col("length") * 10 >= longest).agg(F.max(F.col("length") / F.col("rows"))).first()[0]
    return max(1, int(max_bytes / per_row))


def write_partitioned(df: DataFrame, path: str, key: str = PERIOD,
                      mode: str = "append", *, drop_nulls: bool = False,
                      max_records_per_file: int | None = None,
                      rebalance: bool = False, order_by: Sequence[str] = ()) -> WriteReport:
    """K1: hive-style dataset ``path/key=value/part-*.parquet``.

    Directories are created by the writer. The key is kept in the directory
    name and comes back as a column when the dataset is read. With
    ``drop_nulls`` null keys are dropped as in K5; otherwise they land in the
    ``__HIVE_DEFAULT_PARTITION__`` directory and read back as null. The rows of
    each file are in the order of the columns ``order_by``, which are not stored.
    """
    check_key(df, key)
    df = _prepare(df, key, rebalance, order_by)
    if drop_nulls:
        df, obs = drop_null_keys(df, key)
    else:
        obs = Observation()
        df = df.observe(obs, F.count("*").alias("rows"), F.collect_set(key).alias("keys"))
    with _open_files(df.sparkSession, order_by):
        _writer(df, key, mode, max_records_per_file).save(path)
    return WriteReport(path, True, obs)


def drop_keys(spark: SparkSession, path: str, key: str, values: Iterable[str]) -> list[str]:
    """Delete the stored rows of the given key values of a hive-style dataset; the values that had some."""
    folders = partition_values(spark, path, key) or {}
    gone = [v for v in dict.fromkeys(values) if v in folders]
    for value in gone:
        delete_folder(spark, f"{path.rstrip('/')}/{folders[value]}")
    return gone


# --- catalog tables -------------------------------------------------------

@contextmanager
def scoped_conf(spark: SparkSession, key: str, value: str):
    """Set a SQL conf for one statement and put the old value back."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def _row_bound(spark: SparkSession, rows: int | None):
    """K7 for one statement on a table. A writer option would be kept as a property of the table and rule later writes."""
    return scoped_conf(spark, "spark.sql.files.maxRecordsPerFile", str(int(rows))) if rows else nullcontext()


def _open_files(spark: SparkSession, order_by: Sequence[str]):
    """No sort by the key for one write; rows that are to be stored in order come sorted by it already."""
    return nullcontext() if order_by else scoped_conf(spark, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES))


def ensure_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    """K8: create the database if missing (optionally at a shared location)."""
    loc = f" LOCATION {sql_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}`{loc}")


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def drop_table_keys(spark: SparkSession, table: str, key: str, values: Iterable[str],
                    folder: str | None = None) -> None:
    """Drop the partitions of the given key values; ``folder`` is where an external table keeps its files."""
    if not table_exists(spark, table):
        return
    for value in dict.fromkeys(values):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`{key}` = {sql_text(value)})")
    if folder:
        drop_keys(spark, folder, key, values)


def write_table(df: DataFrame, table: str, key: str = PERIOD, mode: str = "append",
                *, max_records_per_file: int | None = None,
                rebalance: bool = False, folder: str | None = None, order_by: Sequence[str] = ()) -> WriteReport:
    """K2-K7: write to a catalog table partitioned by ``key``.

    * missing table: created from the frame's schema, identity-partitioned by
      ``key`` (K2), with its files under ``folder`` if that is given;
    * missing table and empty input: nothing is left behind (K4); the rows
      are counted by the write itself, so the plan runs once;
    * existing table, ``append``: rows added, columns matched by name (K3);
    * existing table, ``overwrite_partitions``: the input's periods replaced;
      other columns than the table's raise ``ValueError``; ``swap_partitions``
      does the same all-or-nothing, through run folders under ``folder``;
    * null keys are dropped and counted (K5); ``key`` must be a string (K6);
    * ``max_records_per_file`` rolls output files (K7).
    """
    if mode not in ("append", "overwrite_partitions", "swap_partitions"):
        raise ValueError("table mode must be 'append', 'overwrite_partitions' or 'swap_partitions'")
    if mode == "swap_partitions" and not folder:
        raise ValueError("swap_partitions needs the table's folder")
    check_key(df, key)
    spark = df.sparkSession
    exists = table_exists(spark, table)
    clean, obs = drop_null_keys(_prepare(df, key, rebalance, order_by), key)
    report = WriteReport(table, True, obs)
    if not exists or mode == "append":
        # saveAsTable creates the table or appends to it, by column name.
        w = _writer(clean, key, "append", None)
        if folder and not exists:
            w = w.option("path", folder)
        with _row_bound(spark, max_records_per_file), _open_files(spark, order_by):
            w.saveAsTable(table)
        if not exists and not report.rows:
            spark.sql(f"DROP TABLE {table}")
            if folder:
                delete_folder(spark, folder)
            report.written = False
        return report
    cols = spark.table(table).columns
    known, given = ({c.lower() for c in names} for names in (cols, clean.columns))
    for names, what in ((known - given, "missing from input"), (given - known, "not in the table")):
        if names:
            raise ValueError(f"columns {sorted(names)} {what}: {table}")
    if mode == "swap_partitions":
        run = new_run(folder)
        with _open_files(spark, order_by):
            _writer(clean.select(*cols), key, "append", max_records_per_file).save(run)
        swap_partitions(spark, table, key, run, report.keys)
        return report
    with _open_files(spark, order_by):
        overwrite_table_partitions(clean, table, max_records_per_file)
    return report


RUNS = "_runs"


def new_run(folder: str) -> str:
    """A folder for the rows of one run; later ones have later names."""
    return f"{folder.rstrip('/')}/{RUNS}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def swap_partitions(spark: SparkSession, table: str, key: str, run: str, values: Iterable[str]) -> None:
    """Point the partitions of the given key values to a run's folder: one call to the catalog each."""
    folders = partition_values(spark, run, key) or {}
    for value in values:
        spec, place = f"PARTITION (`{key}` = {sql_text(value)})", sql_text(f"{run}/{folders[value]}")
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {spec} LOCATION {place}")
        spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION {place}")
    spark.catalog.refreshTable(table)


def committed_runs(spark: SparkSession, folder: str) -> list[str]:
    """The run folders of a table whose writes were finished, earliest first."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path
    runs = path(f"{folder.rstrip('/')}/{RUNS}")
    fs = runs.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(runs):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(runs))
    return [f"{folder.rstrip('/')}/{RUNS}/{n}" for n in names if fs.exists(path(f"{folder.rstrip('/')}/{RUNS}/{n}/_SUCCESS"))]


def attach_runs(spark: SparkSession, table: str, key: str, folder: str) -> None:
    """In a new session: register the table if only runs hold its rows, and point each partition to the last finished run that has it."""
    runs = committed_runs(spark, folder)
    if not table_exists(spark, table):
        files = file_sizes(spark, runs).where(F.col("path").endswith(".parquet")).agg(F.max("path")).first()[0]
        if not files:
            return
        # the newest file's columns; a run that emptied periods has no file
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(files).schema.fields)
        spark.sql(f"CREATE TABLE {table} ({fields}, `{key}` string) USING parquet PARTITIONED BY (`{key}`) LOCATION {sql_text(folder)}")
    newest: dict[str, str] = {}
    for run in runs:
        newest.update(dict.fromkeys(partition_values(spark, run, key) or {}, run))
    for run in sorted(set(newest.values())):
        swap_partitions(spark, table, key, run, [v for v, r in newest.items() if r == run])


def empty_partitions(spark: SparkSession, table: str, key: str, folder: str, values: Iterable[str]) -> None:
    """Swap in no rows for the given key values, so that an earlier run's rows don't come back."""
    known = {r.partition.split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    gone = [v for v in dict.fromkeys(values) if v in known]
    if not gone:
        return
    run, path = new_run(folder), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(run).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for value in gone:
        fs.mkdirs(path(f"{run}/{key}={value}"))
    fs.create(path(f"{run}/_SUCCESS"), True).close()
    swap_partitions(spark, table, key, run, gone)


def vacuum_runs(spark: SparkSession, table: str, key: str, folder: str) -> list[str]:
    """Delete the folders that no partition points to any more; call it when no reader of old rows is left.

    Only periods that a later finished run has are deleted: folders of a run
    that is being written stay.
    """
    runs, deleted = committed_runs(spark, folder), []
    held = {run: partition_values(spark, run, key) or {} for run in runs}
    for i, run in enumerate([folder.rstrip("/"), *runs]):
        later = set().union(*(held[r] for r in runs[i:]))
        for value, name in (partition_values(spark, run, key) or {}).items():
            if value in later:
                delete_folder(spark, f"{run}/{name}")
                deleted.append(f"{run}/{name}")
        if i and not set(held[run]) - later:
            delete_folder(spark, run)
    return deleted


def overwrite_table_partitions(df: DataFrame, table: str, max_records_per_file: int | None = None) -> None:
    """Replace the partitions of a table that the rows lie in, columns matched by name."""
    spark = df.sparkSession
    # insertInto is positional (hence the select) and ignores writer options
    # (overwrite mode, rows of a file), so the session settings are scoped.
    with scoped_conf(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"), _row_bound(spark, max_records_per_file):
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
