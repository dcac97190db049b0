"""The user-facing stages: clean (L1, L2), analytics (L3, L4) and a full run (L5).

Each stage is one Spark job over all of its periods. Stage outputs go to a
:class:`Storage`: hive-style Parquet datasets under a folder, or catalog
tables in a namespace.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from period_etl.fixed import ANALYTICS, CLEAN, DATE, PERIOD, TOTAL
from period_etl.functions.periods import parse_period
from period_etl.operators.batches import BATCH, live, summed
from period_etl.operators.clean import filter_by_period
from period_etl.operators.lease import Lease, single_writer
from period_etl.operators.rollup import daily_counts
from period_etl.operators.sinks import (
    WriteReport,
    attach_runs,
    committed_runs,
    drop_keys,
    drop_table_keys,
    empty_partitions,
    ensure_namespace,
    file_sizes,
    rows_for_bytes,
    scoped_conf,
    table_exists,
    write_partitioned,
    write_table,
)
from period_etl.sources.landing import INPUT_ORDER, list_landing, read_landing_clean
from period_etl.sources.parquet import (
    key_filter,
    partition_values,
    path_exists,
    read_partitioned,
    scan_parquet,
    stored_values,
)
from period_etl.sources.recorded import record_schema, recorded_schema, records
from period_etl.sources.tables import attach_table

KEY = PERIOD
log = logging.getLogger("period_etl")


@dataclass(frozen=True)
class Storage:
    """Where stage outputs live.

    Path mode (``root``): ``{root}/clean/{data_id}.parquet`` and
    ``{root}/analytics/{data_id}.parquet``. Table mode (``namespace``):
    ``{namespace}.{data_id}_clean`` and ``{namespace}.{data_id}_analytics``;
    ``location`` is the folder under which the tables keep their files, also
    in a namespace that exists already. ``rebalance`` adds one exchange by
    period before a write, for landing sets of many small files.
    ``max_bytes_per_file`` bounds the files that ``clean_all`` writes in bytes
    (``max_records_per_file`` bounds all files in rows). ``swap`` replaces the
    periods of tables all-or-nothing (``swap_partitions``). ``keep_order`` writes
    the rows of each clean file in the order in which they stood in the landing files.
    ``record_schemas`` (path mode) keeps the schemas of what is written beside it, so
    that reads need not merge the footers of all files (see ``sources.recorded``).
    """

    root: str | None = None
    namespace: str | None = None
    location: str | None = None
    max_records_per_file: int | None = None
    rebalance: bool = False
    max_bytes_per_file: int | None = None
    swap: bool = False
    keep_order: bool = False
    record_schemas: bool = False

    def __post_init__(self):
        if self.record_schemas and self.root is None:
            raise ValueError("record_schemas needs a root: a table's schema is in the catalog")
        if self.swap and not (self.namespace and self.location):
            raise ValueError("swap needs a namespace with a location")
        if (self.root is None) == (self.namespace is None):
            raise ValueError("give exactly one of root (path mode) or namespace (table mode)")

    @property
    def tables(self) -> bool:
        return self.namespace is not None

    def target(self, data_id: str, stage: str) -> str:
        if self.tables:
            return f"`{self.namespace}`.`{data_id}_{stage}`"
        return f"{self.root.rstrip('/')}/{stage}/{data_id}.parquet"

    def table_folder(self, data_id: str, stage: str) -> str | None:
        """Where a table of a namespace placed at ``location`` keeps its files."""
        if not (self.tables and self.location):
            return None
        return f"{self.location.rstrip('/')}/{data_id}_{stage}"


def _attach_if_stored(spark: SparkSession, storage: Storage, data_id: str, stage: str) -> None:
    """Table mode in a new session: re-register a stage table whose files exist."""
    folder = storage.table_folder(data_id, stage)
    target = storage.target(data_id, stage)
    if folder is None or table_exists(spark, target):
        return
    stored, runs = partition_values(spark, folder, KEY), committed_runs(spark, folder)
    if stored or runs:
        ensure_namespace(spark, storage.namespace, storage.location)
    if stored:
        attach_table(spark, target, folder)
    if runs:
        attach_runs(spark, target, KEY, folder)


def write_stage(df: DataFrame, storage: Storage, data_id: str, stage: str,
                mode: str, run_periods: Sequence[str] | None = None, order_by: Sequence[str] = ()) -> WriteReport:
    """Store a stage's rows. With ``run_periods`` (the periods that the rows
    stand for) ``overwrite_partitions`` also drops the stored rows of those
    periods that the rows don't have any more, so a rerun leaves what a first
    run would."""
    spark, target = df.sparkSession, storage.target(data_id, stage)
    if stored_batches(spark, storage, data_id, stage):
        raise ValueError(f"{target} is kept by micro-batch; a run can't write to it")
    limits = {"max_records_per_file": storage.max_records_per_file, "rebalance": storage.rebalance, "order_by": order_by}
    if storage.tables:
        ensure_namespace(spark, storage.namespace, storage.location)
        _attach_if_stored(spark, storage, data_id, stage)
        how = "swap_partitions" if storage.swap and mode == "overwrite_partitions" else mode
        report = write_table(df, target, KEY, how, folder=storage.table_folder(data_id, stage), **limits)
    else:
        if storage.record_schemas:
            _record(spark, df, target, order_by)
        report = write_partitioned(df, target, KEY, mode, **limits)
    if run_periods is not None and mode == "overwrite_partitions":
        drop_periods(spark, storage, data_id, stage, set(run_periods) - set(report.keys))
    return report


def _record(spark: SparkSession, df: DataFrame, target: str, order_by: Sequence[str]) -> None:
    """Record the schema of rows that are about to be stored, after that of what was stored before any record."""
    if not records(spark, target) and partition_values(spark, target, KEY):
        record_schema(spark, target, read_partitioned(spark, target, KEY).drop(KEY).schema)
    record_schema(spark, target, df.drop(KEY, *order_by).schema)


def drop_periods(spark: SparkSession, storage: Storage, data_id: str, stage: str,
                 periods: Iterable[str]) -> None:
    """Drop a stage's stored rows of the given periods."""
    gone = sorted(periods)
    if not gone:
        return
    target = storage.target(data_id, stage)
    if storage.tables:
        _attach_if_stored(spark, storage, data_id, stage)
        folder = storage.table_folder(data_id, stage)
        if table_exists(spark, target) and folder and committed_runs(spark, folder):
            empty_partitions(spark, target, KEY, folder, gone)
        else:
            drop_table_keys(spark, target, KEY, gone, folder)
    else:
        drop_keys(spark, target, KEY, gone)


def stage_exists(spark: SparkSession, storage: Storage, data_id: str, stage: str) -> bool:
    target = storage.target(data_id, stage)
    if not storage.tables:
        return path_exists(spark, target)
    _attach_if_stored(spark, storage, data_id, stage)
    return table_exists(spark, target)


def stored_batches(spark: SparkSession, storage: Storage, data_id: str, stage: str) -> dict[str, list[str]]:
    """The micro-batches of each period of a stage that a stream keeps; none for a stage that runs write. Names only."""
    if storage.tables:
        _attach_if_stored(spark, storage, data_id, stage)
        target = storage.target(data_id, stage)
        if not table_exists(spark, target) or BATCH not in spark.table(target).columns:
            return {}
        found: dict[str, list[str]] = {}
        for r in spark.sql(f"SHOW PARTITIONS {target}").collect():
            keys = dict(part.split("=", 1) for part in r.partition.split("/"))
            found.setdefault(keys[KEY], []).append(keys[BATCH])
        return found
    target = storage.target(data_id, stage)
    found = {}
    for i, (period, folder) in enumerate(sorted((partition_values(spark, target, KEY) or {}).items())):
        batches = sorted(partition_values(spark, f"{target}/{folder}", BATCH) or {})
        if not batches and not i:   # one layout for all periods
            return {}
        found[period] = batches
    return found


def read_stage(spark: SparkSession, storage: Storage, data_id: str, stage: str,
               periods: str | Sequence[str] | None = None) -> DataFrame:
    """S3 / S4: a stage's rows, pruned to the given periods.

    Analytics rows come back as ``(date, period, total_trips)``, the order
    they were computed in (a partitioned read puts the key last). What a
    stream keeps by micro-batch comes back whole: clean rows without their
    batch, daily counts summed.
    """
    target = storage.target(data_id, stage)
    if storage.tables:
        _attach_if_stored(spark, storage, data_id, stage)
        df = key_filter(spark.table(target), KEY, periods)
    else:
        schema = recorded_schema(spark, target) if storage.record_schemas else None
        df = read_partitioned(spark, target, KEY, periods, schema=schema and schema.add(KEY, "string"))
    if BATCH in df.columns and (batches := stored_batches(spark, storage, data_id, stage)):
        df = live(df, batches)
        df = summed(df) if stage == ANALYTICS else df.drop(BATCH)
    if stage == ANALYTICS and set(df.columns) == {DATE, KEY, TOTAL}:
        df = df.select(DATE, KEY, TOTAL)
    return df


# --- clean ----------------------------------------------------------------

def clean_period(spark: SparkSession, path: str, period: str, ts_col: str,
                 storage: Storage, data_id: str, mode: str = "append") -> WriteReport:
    """L1: one landing file, one period: scan, month filter, ``period``, store."""
    df = filter_by_period(scan_parquet(spark, path), period, ts_col)
    return write_stage(df, storage, data_id, CLEAN, mode, [period])


def clean_frame(spark: SparkSession, landing_root: str, ts_col: str,
                entries: Sequence[str] | None = None,
                on_duplicate: str = "error", inexact: bool = False, ordered: bool = False, **options: str) -> DataFrame:
    """L2 as a frame: every landing entry, cleaned against its own period;
    ``options`` go to the Parquet reader. ``inexact`` lets numbers that have no
    exact common type in all entries be rounded (else they raise). ``ordered``
    keeps the columns of ``INPUT_ORDER``, which say where a row stood."""
    return read_landing_clean(spark, landing_root, ts_col, entries, on_duplicate, inexact, ordered, **options)


def clean_all(spark: SparkSession, landing_root: str, ts_col: str, storage: Storage,
              data_id: str, mode: str = "overwrite_partitions",
              entries: Sequence[str] | None = None,
              on_duplicate: str = "error", **options: str) -> tuple[list[str], WriteReport]:
    """L2: all periods of a landing set in one scan and one write; ``options``
    go to the Parquet reader."""
    chosen = list_landing(spark, landing_root, entries, on_duplicate)
    names = [e.name for e in chosen]
    log.info("clean: %d landing entries (%s .. %s) -> %s, mode=%s", len(chosen),
             min(e.period for e in chosen), max(e.period for e in chosen),
             storage.target(data_id, CLEAN), mode)
    df = clean_frame(spark, landing_root, ts_col, names, "error", ordered=storage.keep_order, **options)
    periods = sorted(e.period for e in chosen)
    if not storage.max_bytes_per_file:
        return periods, write_stage(df, storage, data_id, CLEAN, mode, periods, INPUT_ORDER if storage.keep_order else ())
    return periods, _write_bounded(df, storage, data_id, mode, periods, [e.path for e in chosen])


def _write_bounded(df: DataFrame, storage: Storage, data_id: str, mode: str, periods: list[str], sources: list[str]) -> WriteReport:
    """K7 in bytes: files of ``max_bytes_per_file`` at most, give or take a tenth.

    The landing files' own bytes a row say how many rows a file may have, and
    the bound how much an exchange that rebalances gives to a task. What was
    written is then measured: if its rows turn out longer, ``overwrite_partitions``
    writes the periods again with that many fewer; ``append`` can't, and warns.
    """
    spark, bound = df.sparkSession, storage.max_bytes_per_file
    rows, before = rows_for_bytes(spark, sources, bound), None
    while True:
        rows = min(r for r in (rows or None, storage.max_records_per_file) if r) if rows or storage.max_records_per_file else None
        with scoped_conf(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(bound)):
            report = write_stage(df, replace(storage, max_records_per_file=rows), data_id, CLEAN, mode, periods,
                                 INPUT_ORDER if storage.keep_order else ())
        folders = _period_folders(spark, storage, data_id, report.keys) if report.written else []
        most = file_sizes(spark, folders).agg(F.max("length")).first()[0] if folders else 0
        if not rows or rows == 1 or (most or 0) <= 1.1 * bound:
            return report
        if mode != "overwrite_partitions" or (before is not None and most >= before):
            log.warning("clean: a file of %d bytes is over the bound of %d", most, bound)
            return report
        rows, before = max(1, min(rows - 1, int(rows * bound / most))), most


def _period_folders(spark: SparkSession, storage: Storage, data_id: str, periods: Iterable[str]) -> list[str]:
    """Where the given periods of the clean stage keep their files."""
    folder = storage.target(data_id, CLEAN)
    if storage.tables:
        folder = storage.table_folder(data_id, CLEAN) or spark.sql(
            f"DESCRIBE TABLE EXTENDED {folder}").where("col_name = 'Location'").first()["data_type"]
    stored = partition_values(spark, folder, KEY) or {}
    return [f"{folder}/{stored[p]}" for p in periods if p in stored]


# --- analytics ------------------------------------------------------------

def _run_clean(spark: SparkSession, storage: Storage, data_id: str,
               periods: Sequence[str], from_min: bool) -> DataFrame:
    """Stored clean rows of the run's periods (or of every period from the
    run's earliest on), read through partition pruning."""
    if not from_min:
        return read_stage(spark, storage, data_id, CLEAN, list(periods))
    if not storage.tables:
        stored = stored_values(spark, storage.target(data_id, CLEAN), KEY)
        if stored is not None:
            later = [p for p in stored if p >= min(periods)] or list(periods)
            return read_stage(spark, storage, data_id, CLEAN, later)
    clean = read_stage(spark, storage, data_id, CLEAN)
    return clean.filter(F.col(KEY) >= F.lit(min(periods)))


def analytics_frame(spark: SparkSession, storage: Storage, data_id: str,
                    periods: Sequence[str], ts_col: str,
                    from_min: bool = False) -> DataFrame:
    """L3/L4 as a frame: daily counts of the stored clean rows of ``periods``.

    The period filter prunes partitions and only ``ts_col`` is read.
    """
    return daily_counts(_run_clean(spark, storage, data_id, periods, from_min), ts_col)


@dataclass
class AnalyticsReport:
    write: WriteReport
    _observation: Observation | None = field(default=None, repr=False)

    @property
    def loaded_rows(self) -> dict[str, int]:
        """A2: clean rows loaded per period (observed on the aggregate)."""
        if self._observation is None or not self.write.written:
            return {}
        out: dict[str, int] = {}
        for row in self._observation.get.get("day_rows") or []:
            out[row[KEY]] = out.get(row[KEY], 0) + int(row["n_rows"])
        return out


def analytics_all(spark: SparkSession, storage: Storage, data_id: str,
                  periods: Sequence[str], ts_col: str, mode: str = "overwrite_partitions",
                  from_min: bool = False) -> AnalyticsReport:
    """L4 (L3 for one period): one aggregate over all run periods, then store.

    The aggregate also counts all loaded rows per day; that small table
    (bounded by calendar days) is handed back as an observed metric, which
    gives A2 without a second pass. It is observed in the stage that writes,
    after the exchange, so a repeated map task counts once. The result is
    hashed by period before the write: one file per period, never more rows
    than days. A clean target that does not exist raises ``FileNotFoundError``;
    one without these periods gives a report with ``written=False``, and
    ``overwrite_partitions`` then drops what analytics had stored for them.
    """
    for p in periods:
        parse_period(p)
    target = storage.target(data_id, ANALYTICS)
    if not stage_exists(spark, storage, data_id, CLEAN):
        raise FileNotFoundError(f"no clean data stored at {storage.target(data_id, CLEAN)}")
    stale = set(periods)
    if from_min and mode == "overwrite_partitions":
        stale |= {p for p in _stored_periods(spark, storage, data_id, ANALYTICS) if p >= min(periods)}
    if not storage.tables:
        stored = stored_values(spark, storage.target(data_id, CLEAN), KEY)
        wanted = set(periods)
        if stored is not None and not [p for p in stored
                                       if (p >= min(periods) if from_min else p in wanted)]:
            # No clean rows stored for these periods: nothing to count.
            log.info("analytics: no clean rows stored for %d periods", len(periods))
            if mode == "overwrite_partitions":
                drop_periods(spark, storage, data_id, ANALYTICS, stale)
            return AnalyticsReport(WriteReport(target, written=False))
    log.info("analytics: %d periods%s -> %s, mode=%s", len(periods),
             " and every later stored one" if from_min else "", target, mode)
    clean = _run_clean(spark, storage, data_id, periods, from_min)
    per_day = daily_counts(clean, ts_col, KEY, with_row_counts=True)
    # Tiny, calendar-bounded output: spread its periods over at most one
    # task per period (an explicit count, so AQE does not fold every
    # period's file into a single writing task).
    setting = spark.conf.get("spark.sql.shuffle.partitions", "200")
    tasks = max(1, min(len(set(periods)), int(setting) if setting.isdigit() else 200))
    obs = Observation()
    per_day = per_day.repartition(tasks, KEY).observe(
        obs, F.collect_list(F.struct(KEY, "n_rows")).alias("day_rows"))
    out = per_day.select(DATE, KEY, TOTAL)
    return AnalyticsReport(write_stage(out, storage, data_id, ANALYTICS, mode, stale), obs)


def _stored_periods(spark: SparkSession, storage: Storage, data_id: str, stage: str) -> list[str]:
    """The periods that a stage has stored, from the partition list alone."""
    if not stage_exists(spark, storage, data_id, stage):
        return []
    target = storage.target(data_id, stage)
    if not storage.tables:
        return stored_values(spark, target, KEY) or []
    return [r.partition.split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {target}").collect()]


def analytics_period(spark: SparkSession, storage: Storage, data_id: str, period: str,
                     ts_col: str, mode: str = "append") -> AnalyticsReport:
    """L3: analytics of one period."""
    return analytics_all(spark, storage, data_id, [period], ts_col, mode)


# --- full run -------------------------------------------------------------

@dataclass
class RunResult:
    periods: list[str]
    clean: WriteReport
    analytics: AnalyticsReport

    @property
    def loaded_rows(self) -> dict[str, int]:
        return self.analytics.loaded_rows


def run_all(spark: SparkSession, landing_root: str, ts_col: str, storage: Storage,
            data_id: str, mode: str = "overwrite_partitions",
            entries: Sequence[str] | None = None, on_duplicate: str = "error",
            from_min: bool = False, lease_seconds: float | None = None, **options: str) -> RunResult:
    """L5: ingest (list the landing set), clean all periods, then analytics.

    Two passes over the data in all (clean, then analytics of the stored
    clean rows), whatever the number of periods. ``mode`` applies to both
    stages: ``overwrite_partitions`` makes reruns idempotent (a period of the
    run that has no rows any more loses its stored ones), ``append``
    keeps the append-only behaviour (a rerun doubles the clean rows and adds
    a second row per day). ``from_min`` recomputes analytics for every
    stored period from the run's earliest one on. With ``lease_seconds`` the run
    holds the output's lease (see ``operators.lease``): a second run at the same
    time raises ``LeaseHeld``.
    """
    if lease_seconds:
        base = storage.root or storage.location
        if base is None:
            raise ValueError("a namespace without a location has no place for the lease")
        with single_writer(spark, f"{base.rstrip('/')}/_leases/{data_id}", lease_seconds) as lease:
            return _run(spark, landing_root, ts_col, storage, data_id, mode, entries, on_duplicate, from_min, lease, options)
    return _run(spark, landing_root, ts_col, storage, data_id, mode, entries, on_duplicate, from_min, None, options)


def _run(spark: SparkSession, landing_root: str, ts_col: str, storage: Storage, data_id: str, mode: str, entries: Sequence[str] | None,
         on_duplicate: str, from_min: bool, lease: Lease | None, options: dict) -> RunResult:
    periods, clean = clean_all(spark, landing_root, ts_col, storage, data_id, mode,
                               entries, on_duplicate, **options)
    if lease:
        lease.renew()   # analytics must not follow a clean that another run has overtaken
    if clean.written:
        analytics = analytics_all(spark, storage, data_id, periods, ts_col, mode, from_min)
    else:  # a first run without a row in its months creates no table
        analytics = AnalyticsReport(WriteReport(storage.target(data_id, ANALYTICS), written=False))
    result = RunResult(periods, clean, analytics)
    if log.isEnabledFor(logging.INFO):
        for period, rows in sorted(result.loaded_rows.items()):
            log.info("loaded %d clean rows for period %s", rows, period)
    return result

