"""

Every query reads the given tables (whole tables, no subsets) or data Spark
derives from them. Queries that store data write under the session's shared
checkpoint folder (``spark.checkpoint.dir``) and use unique names, so the
returned DataFrames stay valid until the driver evaluates them.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from period_etl import (  # noqa: E402
    Storage,
    analytics_all,
    analytics_period,
    clean_all,
    clean_frame,
    clean_period,
    daily_counts,
    ensure_namespace,
    filter_by_period,
    load_counts,
    read_landing,
    read_stage,
    read_table,
    run_all,
    scan_parquet,
    write_partitioned,
    write_table,
)
from period_etl.functions import month_key_col, period_key_col  # noqa: E402
from period_etl.operators.sinks import file_sizes, vacuum_runs  # noqa: E402
from period_etl.plans.changed import read_ledger, run_changed  # noqa: E402
from period_etl.session import scratch_dir, unique_name  # noqa: E402
from period_etl.sources.landing import list_entry_names  # noqa: E402
from period_etl.streaming import process_batch, stream_landing  # noqa: E402
from period_etl.testing import make_landing, shifted_period  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


def _t(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def _landing(spark: SparkSession, sf_dir: str, label: str) -> tuple[str, str]:
    """Scratch folder plus a landing set of ``orders`` under it."""
    base = scratch_dir(spark, label)
    land = make_landing(scan_parquet(spark, _t(sf_dir, "orders")), "o_orderdate",
                        f"{base}/landing", "orders")
    return base, land


def _tables(spark: SparkSession, base: str) -> Storage:
    return Storage(namespace=unique_name("petl"), location=f"{base}/warehouse")


# --- queries --------------------------------------------------------------

def q01_parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_parquet(spark, _t(sf_dir, "orders")).select("*")


def q02_clean_one_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_by_period(scan_parquet(spark, _t(sf_dir, "orders")), "1996-03", "o_orderdate")


def q03_landing_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, land = _landing(spark, sf_dir, "q03")
    return read_landing(spark, land)


def q04_clean_all_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, land = _landing(spark, sf_dir, "q04")
    return clean_frame(spark, land, "o_orderdate")


def q05_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, land = _landing(spark, sf_dir, "q05")
    storage = Storage(root=f"{base}/out")
    clean_all(spark, land, "o_orderdate", storage, "orders")
    return read_stage(spark, storage, "orders", "clean", "1996-03")


def q06_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = filter_by_period(scan_parquet(spark, _t(sf_dir, "events")), "2024-01", "ts")
    return daily_counts(events, "ts")


def q07_analytics_one_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark, "q07")
    storage = Storage(root=f"{base}/out")
    clean_period(spark, _t(sf_dir, "lineitem"), "1997-05", "l_shipdate", storage, "lineitem")
    analytics_period(spark, storage, "lineitem", "1997-05", "l_shipdate")
    return read_stage(spark, storage, "lineitem", "analytics", "1997-05")


def q08_table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark, "q08")
    storage = _tables(spark, base)
    table = storage.target("orders", "clean")
    ensure_namespace(spark, storage.namespace, storage.location)
    rows = q02_clean_one_period(spark, sf_dir)
    write_table(rows, table)                                   # creates the table
    write_table(rows.select(*reversed(rows.columns)), table)   # appends by name
    return spark.table(table)


def q09_table_read_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, land = _landing(spark, sf_dir, "q09")
    storage = _tables(spark, base)
    clean_all(spark, land, "o_orderdate", storage, "orders", mode="append")
    return read_table(spark, storage.target("orders", "clean"), "period", "1997-05")


def q10_rerun_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, land = _landing(spark, sf_dir, "q10")
    storage = Storage(root=f"{base}/out")
    for _ in range(2):
        clean_all(spark, land, "o_orderdate", storage, "orders", mode="overwrite_partitions")
    return load_counts(read_stage(spark, storage, "orders", "clean"))


def q11_null_key_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows outside their entry's month get a null period; the table sink drops them."""
    base, land = _landing(spark, sf_dir, "q11")
    storage = _tables(spark, base)
    ensure_namespace(spark, storage.namespace, storage.location)
    tagged = read_landing(spark, land)
    own = month_key_col(F.col("o_orderdate")) == period_key_col(F.col("period"))
    tagged = tagged.withColumn("period", F.when(own, F.col("period")))
    table = storage.target("orders", "clean")
    write_table(tagged.select("o_orderkey", "o_orderdate", "period"), table)
    return spark.table(table)


def q12_daily_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: landing set -> clean (all periods) -> daily counts, path storage."""
    base, land = _landing(spark, sf_dir, "q12")
    storage = Storage(root=f"{base}/out")
    run_all(spark, land, "o_orderdate", storage, "orders")
    return read_stage(spark, storage, "orders", "analytics")


def q13_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full run in table mode, then rows loaded per period of the run."""
    base, land = _landing(spark, sf_dir, "q13")
    storage = _tables(spark, base)
    result = run_all(spark, land, "o_orderdate", storage, "orders", mode="append")
    return load_counts(read_stage(spark, storage, "orders", "clean", result.periods))


def q14_append_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-only reruns: clean rows double, analytics gains a second row per day."""
    base, land = _landing(spark, sf_dir, "q14")
    storage = Storage(root=f"{base}/out")
    for _ in range(2):
        run_all(spark, land, "o_orderdate", storage, "orders", mode="append")
    return read_stage(spark, storage, "orders", "analytics")


def q15_stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extension: the landing set as a file stream (available-now), clean store."""
    base, land = _landing(spark, sf_dir, "q15")
    storage = Storage(root=f"{base}/out")
    schema = scan_parquet(spark, _t(sf_dir, "orders")).schema
    query = stream_landing(spark, land, schema, "o_orderdate", storage, "orders",
                           f"{base}/checkpoint", analytics=False)
    if not query.awaitTermination(900):
        query.stop()
        raise TimeoutError("landing stream did not finish within 900 s")
    return read_stage(spark, storage, "orders", "clean")


def q16_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries from 1996 on have a further column, those of June store an integer column as double; asked to mix them."""
    root = f"{scratch_dir(spark, 'q16')}/landing"
    orders = scan_parquet(spark, _t(sf_dir, "orders"))
    named = orders.withColumn("p", shifted_period(F.col("o_orderdate")))
    for late in (False, True):
        for wide in (False, True):
            some = named.where((F.col("p") >= "1996-01") == late).where((F.substring("p", 6, 2) == "06") == wide)
            if late:
                some = some.withColumn("fee", F.col("o_orderkey") % 10)
            if wide:
                some = some.withColumn("o_custkey", F.col("o_custkey").cast("double"))
            some.withColumn("entry", F.concat(F.lit("orders_"), "p")).drop("p").write.mode("append").partitionBy("entry").parquet(root)
    return clean_frame(spark, root, "o_orderdate", inexact=True).select(*orders.columns, "fee", "period")


def _emptied_month(spark: SparkSession, sf_dir: str, storage: Storage, base: str, land: str) -> DataFrame:
    """A run, March 1996 delivered again without a row of its own, and the run again."""
    run_all(spark, land, "o_orderdate", storage, "orders")
    may = scan_parquet(spark, f"{land}/entry=orders_1996-05")
    may.write.mode("overwrite").parquet(f"{land}/entry=orders_1996-03")
    run_all(spark, land, "o_orderdate", storage, "orders")
    return read_stage(spark, storage, "orders", "analytics")


def q17_rerun_emptied_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, land = _landing(spark, sf_dir, "q17")
    return _emptied_month(spark, sf_dir, Storage(root=f"{base}/out"), base, land)


def q18_rerun_emptied_month_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, land = _landing(spark, sf_dir, "q18")
    return _emptied_month(spark, sf_dir, _tables(spark, base), base, land)


def q19_analytics_of_stored_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean files written under one namespace, analysed through a fresh one at the same location."""
    base, land = _landing(spark, sf_dir, "q19")
    first, second = _tables(spark, base), _tables(spark, base)
    periods, _ = clean_all(spark, land, "o_orderdate", first, "orders")
    analytics_all(spark, second, "orders", periods, "o_orderdate")
    return read_stage(spark, second, "orders", "analytics")


def q20_observed_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows loaded per period as the run itself observed them."""
    base, land = _landing(spark, sf_dir, "q20")
    result = run_all(spark, land, "o_orderdate", _tables(spark, base), "orders")
    return spark.createDataFrame(sorted(result.loaded_rows.items()), "period string, n_rows long")


def q21_table_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, land = _landing(spark, sf_dir, "q21")
    storage = _tables(spark, base)
    run_all(spark, land, "o_orderdate", storage, "orders", mode="append")
    return read_stage(spark, storage, "orders", "analytics")


def q22_stream_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing stream with analytics, started twice: the second start finds nothing new."""
    base, land = _landing(spark, sf_dir, "q22")
    storage = Storage(root=f"{base}/out")
    schema = scan_parquet(spark, _t(sf_dir, "orders")).schema
    for _ in range(2):
        query = stream_landing(spark, land, schema, "o_orderdate", storage, "orders")
        if not query.awaitTermination(900):
            query.stop()
            raise TimeoutError("landing stream did not finish within 900 s")
    return read_stage(spark, storage, "orders", "analytics")


def q23_bounded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, land = _landing(spark, sf_dir, "q23")
    storage = Storage(root=f"{base}/out", max_records_per_file=50)
    clean_all(spark, land, "o_orderdate", storage, "orders")
    stored = scan_parquet(spark, storage.target("orders", "clean"))
    files = stored.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n"))
    return files.agg(F.sum("n").alias("n_rows"), F.count_if(F.col("n") > 50).alias("files_over"))


def q24_empty_input_no_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark, "q24")
    storage = _tables(spark, base)
    ensure_namespace(spark, storage.namespace, storage.location)
    orders = scan_parquet(spark, _t(sf_dir, "orders"))
    report = write_table(filter_by_period(orders, "2999-01", "o_orderdate"), storage.target("orders", "clean"))
    created = spark.catalog.tableExists(storage.target("orders", "clean"))
    return orders.agg(F.count("*").alias("source_rows")).select(
        "source_rows", F.lit(created).alias("created"), F.lit(report.written).alias("written"))


def q25_key_must_be_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number and a missing column are refused as partition keys before anything is written."""
    orders = scan_parquet(spark, _t(sf_dir, "orders"))
    refused = 0
    for key in ("o_orderkey", "no_such_column"):
        try:
            write_partitioned(orders, f"{scratch_dir(spark, 'q25')}/out", key)
        except ValueError:
            refused += 1
    return orders.agg(F.count("*").alias("source_rows")).select("source_rows", F.lit(refused).alias("refused"))


def q26_mixed_entry_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry names of several layouts, some with blanks, brackets, escapes and letters beyond ASCII."""
    _, land = _landing(spark, sf_dir, "q26")
    layouts = ("orders_{}.parquet", "{} orders.parquet", "orders[v1]_{}", "b\u00e4nde%20{}", "a*{}?")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(land).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for i, name in enumerate(list_entry_names(spark, land)):
        fs.rename(path(f"{land}/{name}"), path(path(land), layouts[i % len(layouts)].format(name[-7:])))
    return read_landing(spark, land)


def q27_from_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run, then a run of the last three entries that recomputes all periods from their first on."""
    base, land = _landing(spark, sf_dir, "q27")
    storage = Storage(root=f"{base}/out")
    run_all(spark, land, "o_orderdate", storage, "orders")
    last = list_entry_names(spark, land)[-3:]
    run_all(spark, land, "o_orderdate", storage, "orders", entries=last, from_min=True)
    return read_stage(spark, storage, "orders", "analytics")


def q28_last_entry_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two entries of March 1996: the later name, with the even keys only, counts."""
    _, land = _landing(spark, sf_dir, "q28")
    march = scan_parquet(spark, f"{land}/entry=orders_1996-03")
    march.where("o_orderkey % 2 = 0").write.parquet(f"{land}/later_1996-03")
    return clean_frame(spark, land, "o_orderdate", on_duplicate="last")


def q29_exact_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """June stores keys as 32-bit integers and prices with fewer digits, July small integers where others have decimals:
    one scan with the types that hold them all."""
    root = f"{scratch_dir(spark, 'q29')}/landing"
    orders = scan_parquet(spark, _t(sf_dir, "orders")).withColumn("p", shifted_period(F.col("o_orderdate")))
    month = F.substring("p", 6, 2)
    for own, key, price, cents in ((month == "06", "int", "decimal(12,2)", "int"), (month == "07", "bigint", "decimal(14,2)", "smallint"),
                                   (~month.isin("06", "07"), "bigint", "decimal(16,4)", "decimal(6,1)")):
        some = orders.where(own).withColumns({
            "o_custkey": F.col("o_custkey").cast(key), "o_totalprice": F.col("o_totalprice").cast(price),
            "cents": (F.col("o_custkey") % 100).cast(cents), "entry": F.concat(F.lit("orders_"), "p")}).drop("p")
        some.write.mode("append").partitionBy("entry").parquet(root)
    clean = clean_frame(spark, root, "o_orderdate")
    return clean.withColumns({"o_totalprice": F.col("o_totalprice").cast("double"), "cents": F.col("cents").cast("double")})


def q30_replayed_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two micro-batches, each done twice as after a failure between storing its rows and noting its epoch."""
    base, land = _landing(spark, sf_dir, "q30")
    storage = Storage(root=f"{base}/out")
    names = list_entry_names(spark, land)
    for epoch, some in enumerate((names[::2], names[1::2])):
        for _ in range(2):
            process_batch(clean_frame(spark, land, "o_orderdate", some), storage, "orders", "o_orderdate", epoch)
    return read_stage(spark, storage, "orders", "analytics")


def q31_stream_partial_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each month arrives in three parts, a part a micro-batch; daily counts are kept by batch and merged by two."""
    base = scratch_dir(spark, "q31")
    storage = _tables(spark, base)
    orders = scan_parquet(spark, _t(sf_dir, "orders"))
    for part in range(3):
        mine = orders.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == part)
        make_landing(mine, "o_orderdate", f"{base}/arrived{part}", f"part{part}")
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs = path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(path(f"{base}/landing"))
        for name in list_entry_names(spark, f"{base}/arrived{part}"):
            fs.rename(path(f"{base}/arrived{part}/{name}"), path(f"{base}/landing/{name}"))
        query = stream_landing(spark, f"{base}/landing", orders.schema, "o_orderdate", storage, "orders", compact_every=2)
        if not query.awaitTermination(900):
            query.stop()
            raise TimeoutError("landing stream did not finish within 900 s")
    return read_stage(spark, storage, "orders", "analytics")


def q32_changed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run, a rerun, a new delivery of March 1996 (that month's rows twice) and a run again: how often each month was
    cleaned and what it holds."""
    base, land = _landing(spark, sf_dir, "q32")
    storage = Storage(root=f"{base}/out")
    for _ in range(2):
        run_changed(spark, land, "o_orderdate", storage, "orders")
    march = scan_parquet(spark, f"{land}/entry=orders_1996-03")
    march.write.parquet(f"{base}/again")
    scan_parquet(spark, f"{base}/again").write.mode("append").parquet(f"{land}/entry=orders_1996-03")
    run_changed(spark, land, "o_orderdate", storage, "orders")
    done = read_ledger(spark, storage, "orders").groupBy("period").agg(F.count("*").alias("runs"))
    held = read_stage(spark, storage, "orders", "analytics").groupBy("period").agg(F.sum("total_trips").alias("n_rows"))
    return done.join(held, "period")


def q33_byte_bounded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of a month in files of 64 kB at most, give or take a tenth."""
    base = scratch_dir(spark, "q33")
    scan_parquet(spark, _t(sf_dir, "events")).write.parquet(f"{base}/landing/events_2024-01")
    storage = Storage(root=f"{base}/out", max_bytes_per_file=64_000)
    clean_all(spark, f"{base}/landing", "ts", storage, "events")
    sizes = file_sizes(spark, [storage.target("events", "clean")]).withColumn("path", F.url_decode("path"))
    rows = read_stage(spark, storage, "events", "clean").groupBy(F.url_decode("_metadata.file_path").alias("path")).agg(F.count("*").alias("n"))
    return sizes.join(rows, "path").agg(F.sum("n").alias("n_rows"), F.count_if(F.col("length") > 70_400).alias("files_over"),
                                        (F.sum("length") < F.count("*") * 20_000).alias("needlessly_small"))


def q34_swapped_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A leased run into tables that swap periods, a run that fails on its way, March 1996 delivered twice over, a run for
    it, and the tables attached anew under another namespace after the old folders are gone."""
    base, land = _landing(spark, sf_dir, "q34")
    first, second = (Storage(namespace=unique_name("petl"), location=f"{base}/warehouse", swap=True) for _ in range(2))
    run_all(spark, land, "o_orderdate", first, "orders", lease_seconds=3600)
    march = scan_parquet(spark, f"{land}/entry=orders_1996-03")
    broken = clean_frame(spark, land, "o_orderdate").withColumn(
        "o_orderpriority", F.when(F.col("period") > "1998", F.raise_error(F.lit("lost on the way"))).otherwise(F.col("o_orderpriority")))
    try:
        write_table(broken, first.target("orders", "clean"), mode="swap_partitions", folder=first.table_folder("orders", "clean"))
    except Exception as error:
        if "lost on the way" not in str(error):
            raise
    march.write.parquet(f"{base}/again")
    scan_parquet(spark, f"{base}/again").write.mode("append").parquet(f"{land}/entry=orders_1996-03")
    run_all(spark, land, "o_orderdate", first, "orders", entries=["entry=orders_1996-03"], lease_seconds=3600)
    for stage in ("clean", "analytics"):
        vacuum_runs(spark, first.target("orders", stage), "period", first.table_folder("orders", stage))
    return read_stage(spark, second, "orders", "analytics")


def q35_input_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries that arrive in descending key order, in two files each, cleaned through an exchange that mixes them: stored
    rows whose key is not below that of the row before them from the same input file."""
    base = scratch_dir(spark, "q35")
    orders = scan_parquet(spark, _t(sf_dir, "orders")).withColumns({
        "entry": F.concat(F.lit("orders_"), shifted_period(F.col("o_orderdate"))), "part": F.pmod(F.xxhash64("o_orderkey"), F.lit(2))})
    for part in range(2):
        orders.where(F.col("part") == part).repartition("entry").sortWithinPartitions("entry", F.desc("o_orderkey")).write.mode("append").partitionBy(
            "entry").parquet(f"{base}/landing")
    storage = Storage(root=f"{base}/out", rebalance=True, keep_order=True)
    clean_all(spark, f"{base}/landing", "o_orderdate", storage, "orders")
    stored = read_stage(spark, storage, "orders", "clean").select(
        "o_orderkey", "part", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    before = Window.partitionBy("f", "part").orderBy("i")
    runs = Window.partitionBy("f").orderBy("i")
    checked = stored.withColumns({"up": F.lag("o_orderkey").over(before) <= F.col("o_orderkey"), "turn": F.lag("part").over(runs) != F.col("part")})
    files = checked.groupBy("f").agg(F.count("*").alias("n"), F.count_if("up").alias("up"), F.count_if("turn").alias("turns"))
    return files.agg(F.sum("n").alias("n_rows"), F.sum("up").alias("out_of_order"), F.count_if(F.col("turns") > 1).alias("mixed_files"))


def q36_recorded_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years before 1996 with 32-bit customers, then the others with a fee, read back by the schemas recorded beside the data."""
    base = scratch_dir(spark, "q36")
    orders = scan_parquet(spark, _t(sf_dir, "orders"))
    storage = Storage(root=f"{base}/out", record_schemas=True)
    late = shifted_period(F.col("o_orderdate")) >= "1996-01"
    for name, rows in (("early", orders.where(~late).withColumn("o_custkey", F.col("o_custkey").cast("int"))),
                       ("late", orders.where(late).withColumn("fee", F.col("o_orderkey") % 10))):
        clean_all(spark, make_landing(rows, "o_orderdate", f"{base}/{name}", "orders"), "o_orderdate", storage, "orders")
    return read_stage(spark, storage, "orders", "clean").select(*orders.columns, "fee", "period")


def q37_from_min_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run, then March 1996 appended again with the counts of all periods from there on: these have two rows a day."""
    base, land = _landing(spark, sf_dir, "q37")
    storage = Storage(root=f"{base}/out")
    run_all(spark, land, "o_orderdate", storage, "orders", mode="append")
    march = [e for e in list_entry_names(spark, land) if "1996-03" in e]
    run_all(spark, land, "o_orderdate", storage, "orders", mode="append", entries=march, from_min=True)
    return read_stage(spark, storage, "orders", "analytics")



_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q01_parquet_scan": q01_parquet_scan,
    "q02_clean_one_period": q02_clean_one_period,
    "q03_landing_periods": q03_landing_periods,
    "q04_clean_all_periods": q04_clean_all_periods,
    "q05_partitioned_roundtrip": q05_partitioned_roundtrip,
    "q06_daily_counts": q06_daily_counts,
    "q07_analytics_one_period": q07_analytics_one_period,
    "q08_table_append": q08_table_append,
    "q09_table_read_filtered": q09_table_read_filtered,
    "q10_rerun_overwrite": q10_rerun_overwrite,
    "q11_null_key_drop": q11_null_key_drop,
    "q12_daily_rollup": q12_daily_rollup,
    "q13_load_counts": q13_load_counts,
    "q14_append_rerun": q14_append_rerun,
    "q15_stream_landing": q15_stream_landing,
    "q16_schema_drift": q16_schema_drift,
    "q17_rerun_emptied_month": q17_rerun_emptied_month,
    "q18_rerun_emptied_month_tables": q18_rerun_emptied_month_tables,
    "q19_analytics_of_stored_files": q19_analytics_of_stored_files,
    "q20_observed_load_counts": q20_observed_load_counts,
    "q21_table_analytics": q21_table_analytics,
    "q22_stream_restarted": q22_stream_restarted,
    "q23_bounded_files": q23_bounded_files,
    "q24_empty_input_no_table": q24_empty_input_no_table,
    "q25_key_must_be_text": q25_key_must_be_text,
    "q26_mixed_entry_names": q26_mixed_entry_names,
    "q27_from_min": q27_from_min,
    "q28_last_entry_wins": q28_last_entry_wins,
    "q29_exact_drift": q29_exact_drift,
    "q30_replayed_epoch": q30_replayed_epoch,
    "q31_stream_partial_counts": q31_stream_partial_counts,
    "q32_changed_entries": q32_changed_entries,
    "q33_byte_bounded_files": q33_byte_bounded_files,
    "q34_swapped_periods": q34_swapped_periods,
    "q35_input_order": q35_input_order,
    "q36_recorded_schemas": q36_recorded_schemas,
    "q37_from_min_appended": q37_from_min_appended,
}

# --- oracles --------------------------------------------------------------

_M = "strftime(o_orderdate, '%Y-%m')"
_N = "strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m')"
_Q02 = ("SELECT *, '1996-03' AS period FROM orders "
        "WHERE year(o_orderdate) = 1996 AND month(o_orderdate) = 3")
_Q04 = f"SELECT *, {_M} AS period FROM orders WHERE {_M} = {_N}"
_DAILY = (f"SELECT CAST(o_orderdate AS DATE) AS date, {_M} AS period, "
          f"count(*) AS total_trips FROM orders WHERE {_M} = {_N} GROUP BY 1, 2")

_LOADED = f"SELECT {_M} AS period, count(*) AS n_rows FROM orders WHERE {_M} = {_N} GROUP BY 1"

_ORACLE = {
    "q01_parquet_scan": "SELECT * FROM orders",
    "q02_clean_one_period": _Q02,
    "q03_landing_periods": f"SELECT *, {_N} AS period FROM orders",
    "q04_clean_all_periods": _Q04,
    "q05_partitioned_roundtrip": f"{_Q04} AND {_M} = '1996-03'",
    "q06_daily_counts": (
        "SELECT CAST(ts AS DATE) AS date, '2024-01' AS period, count(*) AS total_trips "
        "FROM events WHERE year(ts) = 2024 AND month(ts) = 1 GROUP BY 1"),
    "q07_analytics_one_period": (
        "SELECT CAST(l_shipdate AS DATE) AS date, '1997-05' AS period, "
        "count(*) AS total_trips FROM lineitem "
        "WHERE year(l_shipdate) = 1997 AND month(l_shipdate) = 5 GROUP BY 1"),
    "q08_table_append": f"{_Q02} UNION ALL {_Q02}",
    "q09_table_read_filtered": f"{_Q04} AND {_M} = '1997-05'",
    "q10_rerun_overwrite": (
        f"SELECT {_M} AS period, count(*) AS n_rows FROM orders WHERE {_M} = {_N} GROUP BY 1"),
    "q11_null_key_drop": (
        f"SELECT o_orderkey, o_orderdate, {_M} AS period FROM orders WHERE {_M} = {_N}"),
    "q12_daily_rollup": _DAILY,
    "q13_load_counts": _LOADED,
    "q14_append_rerun": (
        f"SELECT date, period, total_trips FROM ({_DAILY}) "
        f"UNION ALL SELECT date, period, 2 * total_trips AS total_trips FROM ({_DAILY})"),
    "q15_stream_landing": _Q04,
    "q16_schema_drift": (
        f"SELECT * REPLACE (CAST(o_custkey AS DOUBLE) AS o_custkey), "
        f"CASE WHEN {_M} >= '1996-01' THEN o_orderkey % 10 END AS fee, {_M} AS period FROM orders WHERE {_M} = {_N}"),
    "q17_rerun_emptied_month": f"SELECT * FROM ({_DAILY}) WHERE period <> '1996-03'",
    "q18_rerun_emptied_month_tables": f"SELECT * FROM ({_DAILY}) WHERE period <> '1996-03'",
    "q19_analytics_of_stored_files": _DAILY,
    "q20_observed_load_counts": _LOADED,
    "q21_table_analytics": _DAILY,
    "q22_stream_restarted": _DAILY,
    "q23_bounded_files": f"SELECT count(*) AS n_rows, 0 AS files_over FROM orders WHERE {_M} = {_N}",
    "q24_empty_input_no_table": "SELECT count(*) AS source_rows, false AS created, false AS written FROM orders",
    "q25_key_must_be_text": "SELECT count(*) AS source_rows, 2 AS refused FROM orders",
    "q26_mixed_entry_names": f"SELECT *, {_N} AS period FROM orders",
    "q27_from_min": _DAILY,
    "q29_exact_drift": (
        f"SELECT * REPLACE (round(o_totalprice, 2) AS o_totalprice), CAST(o_custkey % 100 AS DOUBLE) AS cents, {_M} AS period FROM orders WHERE {_M} = {_N}"),
    "q30_replayed_epoch": _DAILY,
    "q31_stream_partial_counts": _DAILY,
    "q32_changed_entries": (
        f"SELECT period, CASE WHEN period = '1996-03' THEN 2 ELSE 1 END AS runs, "
        f"CAST(n_rows * CASE WHEN period = '1996-03' THEN 2 ELSE 1 END AS BIGINT) AS n_rows FROM ({_LOADED})"),
    "q33_byte_bounded_files": "SELECT count(*) AS n_rows, 0 AS files_over, false AS needlessly_small FROM events",
    "q34_swapped_periods": (
        f"SELECT date, period, total_trips * CASE WHEN period = '1996-03' THEN 2 ELSE 1 END AS total_trips FROM ({_DAILY})"),
    "q35_input_order": f"SELECT count(*) AS n_rows, 0 AS out_of_order, 0 AS mixed_files FROM orders WHERE {_M} = {_N}",
    "q36_recorded_schemas": (
        f"SELECT *, CASE WHEN {_N} >= '1996-01' THEN o_orderkey % 10 END AS fee, {_M} AS period FROM orders WHERE {_M} = {_N}"),
    "q37_from_min_appended": (
        f"{_DAILY} UNION ALL SELECT date, period, total_trips * CASE WHEN period = '1996-03' THEN 2 ELSE 1 END AS total_trips FROM ({_DAILY}) "
        "WHERE period >= '1996-03'"),
    "q28_last_entry_wins": f"{_Q04} AND ({_M} <> '1996-03' OR o_orderkey % 2 = 0)",
}


# The operators of the llm subpackage and their pipeline are optional: without them the rest stays as it is.
try:
    from period_etl.llm.queries import ORACLE_SQL as _LLM_ORACLE  # noqa: E402
    from period_etl.llm.queries import QUERIES as _LLM_QUERIES  # noqa: E402
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith("period_etl.llm"):
        raise
else:
    _QUERIES |= _LLM_QUERIES
    _ORACLE |= _LLM_ORACLE

try:
    import corpus_pipeline as _pipeline  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name != "corpus_pipeline" and not (missing.name or "").startswith("period_etl.llm"):
        raise
else:
    _QUERIES["pipeline"] = _pipeline.run
    if _pipeline.ORACLE_SQL:
        _ORACLE["pipeline"] = _pipeline.ORACLE_SQL


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query (q12) on /root/testdata/sf0.001."""
    return q12_daily_rollup(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)
