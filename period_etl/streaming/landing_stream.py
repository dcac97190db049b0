"""Extension (stated intent only in the reference): stream a landing folder.

New landing files are picked up by Spark's file stream source; each
micro-batch runs the same clean transform as the batch path (rows outside
their entry's month are dropped).

Delivery is exactly-once. A batch's clean rows are stored under
``period=../batch=<epoch>`` and its daily counts, of its own rows only, beside
them in the same way; both writes replace just these partitions. Spark gives a
replayed epoch the same files, so a replay after a failure replaces what the
first try left. ``read_stage`` sums the counts of all batches. A batch reads
what it brings, however much its months hold already; ``compact_every`` merges
the counts of that many batches into one, of that many such ones into one, and
so on, so reads stay short and each count is merged a logarithm of times.

Entry names are checked per row here (the set of entries is not known up
front): a file whose entry has no ``YYYY-MM`` fails the batch. Two entries of
one period are both kept. A stage that runs have written can't be streamed
into, nor the other way round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from period_etl.fixed import ANALYTICS, CLEAN, DATE, PERIOD, TOTAL
from period_etl.operators.batches import BATCH, batch_name, batch_span, covered, summed
from period_etl.operators.clean import clean_tagged
from period_etl.operators.rollup import daily_counts
from period_etl.operators.sinks import ensure_namespace, overwrite_table_partitions, table_exists
from period_etl.plans.stages import Storage, stored_batches
from period_etl.sources.landing import qualify, tag_period
from period_etl.sources.parquet import delete_folder, partition_values, scan_parquet
from period_etl.sources.tables import sql_text

_FP = "__period_etl_file_path"


def read_landing_stream(spark: SparkSession, root: str, schema: StructType,
                        **options: str) -> DataFrame:
    """Streaming S2: files appearing under ``root`` with their ``period``."""
    root = qualify(spark, root)
    df = (spark.readStream.schema(schema)
          .option("recursiveFileLookup", "true")
          .options(**options)
          .parquet(root))
    df = df.select("*", F.col("_metadata.file_path").alias(_FP))
    return tag_period(df, root, _FP, checked=True)


def _checkpoint(storage: Storage, data_id: str) -> str:
    """The stream's own folder beside its output: the same in every run, so a restart goes on where it was."""
    base = storage.root or storage.location
    if base is None:
        raise ValueError("a namespace without a location needs checkpoint_location")
    return f"{base.rstrip('/')}/_streams/{data_id}"


def _write_batch(df: DataFrame, storage: Storage, data_id: str, stage: str, name: str) -> list[str]:
    """Store the rows as the batch ``name``, instead of what it may have stored before; the periods that it has rows of."""
    spark, target = df.sparkSession, storage.target(data_id, stage)
    batches = stored_batches(spark, storage, data_id, stage)
    obs = Observation()
    df = df.observe(obs, F.collect_set(PERIOD).alias("periods")).withColumn(BATCH, F.lit(name))
    new = not (table_exists(spark, target) if storage.tables else partition_values(spark, target, PERIOD))
    if not new and not batches:
        raise ValueError(f"{target} is written by runs; a stream can't add batches to it")
    if storage.tables and not new:
        overwrite_table_partitions(df, target)
    else:
        w = df.write.format("parquet").partitionBy(PERIOD, BATCH)
        if storage.max_records_per_file:
            w = w.option("maxRecordsPerFile", int(storage.max_records_per_file))
        if storage.tables:
            ensure_namespace(spark, storage.namespace, storage.location)
            if folder := storage.table_folder(data_id, stage):
                w = w.option("path", folder)
            w.mode("append").saveAsTable(target)
        else:
            w.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(target)
    periods = sorted(obs.get.get("periods") or [])
    if storage.tables and new and not periods:   # no row yet, no table yet
        spark.sql(f"DROP TABLE {target}")
        if folder := storage.table_folder(data_id, stage):
            delete_folder(spark, folder)
    return periods


def read_batch(spark: SparkSession, storage: Storage, data_id: str, stage: str, name: str, periods: list[str]) -> DataFrame:
    """The rows of one batch: only its own folders are listed and read."""
    target = storage.target(data_id, stage)
    if storage.tables:
        return spark.table(target).filter((F.col(BATCH) == name) & F.col(PERIOD).isin(periods))
    df = scan_parquet(spark, *[f"{target}/{PERIOD}={p}/{BATCH}={name}" for p in periods], basePath=target)
    return df.withColumn(PERIOD, F.col(PERIOD).cast("string"))


def process_batch(batch: DataFrame, storage: Storage, data_id: str, ts_col: str, epoch: int, analytics: bool = True) -> list[str]:
    """Store a micro-batch's clean rows and their daily counts under its epoch; the periods that it has rows of.

    Doing it again for the same epoch leaves what doing it once does. The
    counts are taken from the timestamps just stored.
    """
    spark, name = batch.sparkSession, batch_name(epoch)
    periods = _write_batch(batch, storage, data_id, CLEAN, name)
    if analytics and periods:
        counts = daily_counts(read_batch(spark, storage, data_id, CLEAN, name, periods), ts_col)
        _write_batch(counts.select(DATE, TOTAL, PERIOD).coalesce(1), storage, data_id, ANALYTICS, name)
    return periods


def compact_counts(spark: SparkSession, storage: Storage, data_id: str, first: int, last: int) -> None:
    """Merge the daily counts of the epochs ``first`` to ``last``, which must all be done, into one batch.

    Readers leave out the merged batches as soon as the new one is there, so
    every count is seen once, also if this stops half-way and runs again.
    """
    stored = stored_batches(spark, storage, data_id, ANALYTICS)
    target, name = storage.target(data_id, ANALYTICS), batch_name(first, last)

    def within(names):
        gone = covered(names)
        return [n for n in names if n not in gone and first <= batch_span(n)[0] and batch_span(n)[1] <= last]

    parts = {p: inside for p, names in stored.items() if len(inside := within(names)) > 1 or (inside and inside != [name])}
    if parts:
        df = None
        for wanted in sorted(set(map(tuple, parts.values()))):   # few: a stretch of batches touches few sets of periods
            periods = [p for p, names in parts.items() if tuple(names) == wanted]
            some = [read_batch(spark, storage, data_id, ANALYTICS, n, periods).select(DATE, TOTAL, PERIOD) for n in wanted]
            for part in some:
                df = part if df is None else df.unionByName(part)
        _write_batch(summed(df).select(DATE, TOTAL, PERIOD).coalesce(1), storage, data_id, ANALYTICS, name)
    for period, names in stored_batches(spark, storage, data_id, ANALYTICS).items():
        for old in sorted(covered(names)):
            if storage.tables:
                spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({PERIOD} = {sql_text(period)}, {BATCH} = {sql_text(old)})")
            folder = storage.table_folder(data_id, ANALYTICS) if storage.tables else target
            if folder:
                delete_folder(spark, f"{folder}/{PERIOD}={period}/{BATCH}={old}")


def _compact_due(spark: SparkSession, storage: Storage, data_id: str, epoch: int, every: int) -> None:
    size = every
    while epoch and epoch % size == 0:
        compact_counts(spark, storage, data_id, epoch - size, epoch - 1)
        size *= every


def stream_landing(spark: SparkSession, root: str, schema: StructType, ts_col: str,
                   storage: Storage, data_id: str, checkpoint_location: str | None = None,
                   analytics: bool = True, available_now: bool = True,
                   processing_time: str | None = None,
                   max_files_per_trigger: int | None = None, compact_every: int = 0,
                   **source_options: str) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops.

    Without ``checkpoint_location`` the progress is kept beside the output
    (``_streams/{data_id}``), so a later start reads new files only.

    ``source_options`` go to the file source, e.g. ``maxFileAge`` or
    ``cleanSource="archive"`` with ``sourceArchiveDir`` to keep the listing
    of a long-running stream from growing with its history.
    """
    ckpt = checkpoint_location or _checkpoint(storage, data_id)
    options = dict(source_options)
    if max_files_per_trigger:
        options["maxFilesPerTrigger"] = str(max_files_per_trigger)
    clean = clean_tagged(read_landing_stream(spark, root, schema, **options), ts_col)

    def one_batch(batch: DataFrame, epoch_id: int) -> None:
        if compact_every > 1 and analytics:   # the epochs before this one are done: none of them is replayed
            _compact_due(batch.sparkSession, storage, data_id, epoch_id, compact_every)
        process_batch(batch, storage, data_id, ts_col, epoch_id, analytics)

    writer = clean.writeStream.foreachBatch(one_batch).option("checkpointLocation", ckpt)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
