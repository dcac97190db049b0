"""Reruns that clean only new or changed landing entries (L2 and L5 made incremental).

A ledger beside the output remembers each entry's fingerprint: the names, lengths and
modification times of its files, folded into one row per entry without reading
them. A rerun takes the fingerprints anew, anti-joins them with the ledger's
last ones, and runs for the rest. The ledger gets its rows after the run, so a
run that fails is done again; ``overwrite_partitions`` makes that harmless.
Entries that have gone keep what they had stored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from period_etl.fixed import PERIOD
from period_etl.functions.periods import entry_name_col
from period_etl.plans.stages import RunResult, Storage, run_all
from period_etl.sources.landing import list_landing, qualify
from period_etl.sources.parquet import literal_path, path_exists

_LEDGER = "entry string, period string, files long, bytes long, print long, run long"


@dataclass
class ChangedRun:
    """The entries that were done, and what the run did; ``result`` is None if there was nothing to do."""

    entries: list[str]
    result: RunResult | None


def ledger_path(storage: Storage, data_id: str) -> str:
    base = storage.root or storage.location
    if base is None:
        raise ValueError("a namespace without a location has no place for the ledger")
    return f"{base.rstrip('/')}/_ledger/{data_id}"


def fingerprints(spark: SparkSession, root: str, entries: list[str] | None = None, on_duplicate: str = "error") -> DataFrame:
    """(entry, period, files, bytes, print) of each landing entry: a listing in tasks, no file is opened."""
    root = qualify(spark, root)
    chosen = list_landing(spark, root, entries, on_duplicate)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([literal_path(e.path) for e in chosen])
    # the content isn't asked for, so Spark doesn't read it
    one = files.select(F.url_decode(entry_name_col(F.col("path"), root)).alias("entry"), "length",
                       F.xxhash64("path", "length", F.col("modificationTime").cast("long"), F.date_format("modificationTime", "SSSSSS")).alias("print"))
    each = one.groupBy("entry").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.bit_xor("print").alias("print"))
    periods = spark.createDataFrame([(e.name, e.period) for e in chosen], "entry string, period string")
    return periods.join(each, "entry").select("entry", PERIOD, "files", "bytes", "print")


def read_ledger(spark: SparkSession, storage: Storage, data_id: str) -> DataFrame:
    """Every row that runs have written: (entry, period, files, bytes, print, run), runs from 0."""
    path = ledger_path(storage, data_id)
    if not path_exists(spark, path):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(path)


def changed_entries(now: DataFrame, ledger: DataFrame) -> DataFrame:
    """The fingerprints that are not an entry's last ones in the ledger."""
    newest = ledger.withColumn("_nth", F.row_number().over(Window.partitionBy("entry").orderBy(F.desc("run")))).where("_nth = 1")
    return now.join(newest.select("entry", PERIOD, "files", "bytes", "print"), ["entry", PERIOD, "files", "bytes", "print"], "left_anti")


def run_changed(spark: SparkSession, landing_root: str, ts_col: str, storage: Storage, data_id: str,
                entries: list[str] | None = None, on_duplicate: str = "error", **options: str) -> ChangedRun:
    """L5 for the entries that are new or differ from what the last run of them saw; their periods are replaced."""
    now = fingerprints(spark, landing_root, entries, on_duplicate)
    ledger = read_ledger(spark, storage, data_id)
    # one row for each entry to be done, which the driver lists anyway; taken before the data is read, so that an
    # entry that changes while it is read is done again
    todo = changed_entries(now, ledger).collect()
    if not todo:
        return ChangedRun([], None)
    names = sorted(r.entry for r in todo)
    result = run_all(spark, landing_root, ts_col, storage, data_id, "overwrite_partitions", names, "error", **options)
    last = ledger.agg(F.max("run")).first()[0]
    done = [(r.entry, r.period, r.files, r.bytes, r.print, 0 if last is None else last + 1) for r in todo]
    spark.createDataFrame(done, _LEDGER).coalesce(1).write.mode("append").parquet(ledger_path(storage, data_id))
    return ChangedRun(names, result)
