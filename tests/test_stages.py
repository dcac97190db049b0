"""Stage-level properties: whole runs in both storage modes, reruns, plans."""

import os

import pytest
from pyspark.sql import functions as F

from period_etl import (
    Storage,
    analytics_frame,
    clean_all,
    clean_frame,
    read_stage,
    run_all,
    scan_parquet,
)
from period_etl.session import unique_name
from period_etl.testing import make_landing

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def landing(spark, scratch):
    orders = scan_parquet(spark, f"{SF}/orders.parquet")
    return make_landing(orders, "o_orderdate", f"{scratch}/landing", "orders")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def expected_clean(spark):
    o = scan_parquet(spark, f"{SF}/orders.parquet")
    m = F.date_format("o_orderdate", "yyyy-MM")
    n = F.date_format(F.date_add(F.to_date("o_orderdate"), 1), "yyyy-MM")
    return o.filter(m == n).withColumn("period", m)


@pytest.mark.parametrize("mode", ["path", "table"])
def test_run_all(spark, scratch, landing, mode):
    storage = (Storage(root=f"{scratch}/out") if mode == "path"
               else Storage(namespace=unique_name("run"), location=f"{scratch}/wh"))
    result = run_all(spark, landing, "o_orderdate", storage, "orders")
    clean = read_stage(spark, storage, "orders", "clean")
    want = expected_clean(spark)
    assert clean.select(*want.columns).exceptAll(want).count() == 0
    assert want.exceptAll(clean.select(*want.columns)).count() == 0
    analytics = read_stage(spark, storage, "orders", "analytics")
    total = analytics.agg(F.sum("total_trips")).first()[0]
    assert total == want.count()
    per_period = {r.period: r.n for r in want.groupBy("period").agg(F.count("*").alias("n")).collect()}
    assert result.loaded_rows == per_period
    assert set(per_period) <= set(result.periods)


def test_overwrite_rerun_is_idempotent(spark, scratch, landing):
    storage = Storage(root=f"{scratch}/out")
    run_all(spark, landing, "o_orderdate", storage, "orders")
    first = read_stage(spark, storage, "orders", "analytics").collect()
    run_all(spark, landing, "o_orderdate", storage, "orders")
    assert sorted(read_stage(spark, storage, "orders", "analytics").collect()) == sorted(first)


def test_append_rerun_doubles(spark, scratch, landing):
    storage = Storage(root=f"{scratch}/out")
    run_all(spark, landing, "o_orderdate", storage, "orders", mode="append")
    n = read_stage(spark, storage, "orders", "clean").count()
    run_all(spark, landing, "o_orderdate", storage, "orders", mode="append")
    assert read_stage(spark, storage, "orders", "clean").count() == 2 * n
    a = read_stage(spark, storage, "orders", "analytics")
    per_day = a.groupBy("date", "period").agg(F.min("total_trips").alias("lo"),
                                              F.max("total_trips").alias("hi"),
                                              F.count("*").alias("k"))
    assert per_day.filter("k != 2 OR hi != 2 * lo").count() == 0


def test_overwrite_touches_only_run_periods(spark, scratch, landing):
    storage = Storage(root=f"{scratch}/out")
    clean_all(spark, landing, "o_orderdate", storage, "orders")
    before = read_stage(spark, storage, "orders", "clean").groupBy("period").count().collect()
    one = [e for e in sorted(os.listdir(landing.replace("file:", "")))
           if e.startswith("entry=")][:1]
    clean_all(spark, landing, "o_orderdate", storage, "orders", entries=one)
    after = read_stage(spark, storage, "orders", "clean").groupBy("period").count().collect()
    assert sorted(before) == sorted(after)


def test_incremental_from_min(spark, scratch, landing):
    storage = Storage(root=f"{scratch}/out")
    full = run_all(spark, landing, "o_orderdate", storage, "orders")
    first = sorted(read_stage(spark, storage, "orders", "analytics").collect())
    names = sorted(e for e in os.listdir(landing.replace("file:", ""))
                   if e.startswith("entry="))
    later = run_all(spark, landing, "o_orderdate", storage, "orders",
                    entries=names[-3:], from_min=True)
    assert min(later.periods) > min(full.periods)
    assert sorted(read_stage(spark, storage, "orders", "analytics").collect()) == first


def test_plans(spark, scratch, landing):
    storage = Storage(root=f"{scratch}/out")
    periods, _ = clean_all(spark, landing, "o_orderdate", storage, "orders")
    # clean: one scan, no shuffle
    assert "Exchange" not in plan(clean_frame(spark, landing, "o_orderdate"))
    # analytics: pruned partitions, only the timestamp read, one exchange
    a = analytics_frame(spark, storage, "orders", periods[:2], "o_orderdate")
    text = a._jdf.queryExecution().sparkPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in text or "PartitionFilters: [period" in text
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in text
    executed = plan(a)                       # exchanges are placed here
    assert executed.count("Exchange hashpartitioning") == 1
    assert "partial_count" in executed      # map-side combine before the exchange


@pytest.mark.parametrize("mode", ["path", "table"])
def test_run_with_no_rows_in_month(spark, scratch, trips, mode):
    root = f"{scratch}/landing"
    # every row of this entry lies outside March 2025
    trips.coalesce(1).write.parquet(f"{root}/trips_2025-03.parquet")
    storage = (Storage(root=f"{scratch}/out") if mode == "path"
               else Storage(namespace=unique_name("empty"), location=f"{scratch}/wh"))
    result = run_all(spark, root, "ts", storage, "trips")
    assert result.periods == ["2025-03"]
    assert not result.analytics.write.written
    assert result.loaded_rows == {}
    if mode == "table":
        assert not spark.catalog.tableExists(storage.target("trips", "clean"))


def test_table_mode_reattaches_stored_tables(spark, scratch, trips):
    """A new session's empty catalog: stage tables are re-attached from their folders."""
    from period_etl import write_partitioned
    storage = Storage(namespace=unique_name("again"), location=f"{scratch}/wh")
    # files left by an earlier session at the table's folder
    old = trips.filter("id = 1").withColumn("period", F.lit("2025-01"))
    write_partitioned(old, storage.table_folder("trips", "clean"))
    assert not spark.catalog.tableExists(storage.target("trips", "clean"))
    assert read_stage(spark, storage, "trips", "clean").count() == 1
    from period_etl.plans.stages import write_stage
    write_stage(trips.filter("id = 7").withColumn("period", F.lit("2025-01")),
                storage, "trips", "clean", "append")
    assert sorted(r.id for r in read_stage(spark, storage, "trips", "clean", "2025-01").collect()) == [1, 7]


def test_analytics_writes_one_file_per_period(spark, scratch, landing):
    import glob
    storage = Storage(root=f"{scratch}/out")
    result = run_all(spark, landing, "o_orderdate", storage, "orders")
    folder = storage.target("orders", "analytics").replace("file:", "")
    files = glob.glob(f"{folder}/period=*/*.parquet")
    assert len(files) == len({f.split("period=")[1].split("/")[0] for f in files})
    assert len(files) == len(result.loaded_rows)


def test_single_period_stages_in_table_mode(spark, scratch, trips):
    from period_etl import analytics_period, clean_period
    path = f"{scratch}/trips_2025-01.parquet"
    trips.coalesce(1).write.parquet(path)
    storage = Storage(namespace=unique_name("one"), location=f"{scratch}/wh")
    report = clean_period(spark, path, "2025-01", "ts", storage, "trips")
    assert report.written and report.dropped_null_keys == 0
    analytics_period(spark, storage, "trips", "2025-01", "ts")
    a = read_stage(spark, storage, "trips", "analytics", "2025-01")
    assert a.columns == ["date", "period", "total_trips"]
    assert sorted((str(r.date), r.total_trips) for r in a.collect()) == [
        ("2025-01-01", 2), ("2025-01-31", 1)]


def test_rows_keep_their_input_order(spark, scratch):
    """Through an exchange as well, in path and table mode, and with bounded files."""
    rows = spark.range(2000).select(F.expr("timestamp_ntz'2025-01-01' + make_interval(0, 0, 0, id % 28)").alias("ts"), (F.lit(5000) - F.col("id")).alias("id"))
    rows.coalesce(1).write.parquet(f"{scratch}/land/t_2025-01")
    for storage in (Storage(root=f"{scratch}/a", keep_order=True), Storage(root=f"{scratch}/b", keep_order=True, rebalance=True, max_records_per_file=300),
                    Storage(namespace=unique_name("ord"), location=f"{scratch}/wh", keep_order=True, rebalance=True)):
        clean_all(spark, f"{scratch}/land", "ts", storage, "t")
        df = read_stage(spark, storage, "t", "clean")
        assert set(df.columns) == {"ts", "id", "period"}
        held = df.select("id", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i")).orderBy("f", "i").collect()
        assert len(held) == 2000 and all(a.id > b.id for a, b in zip(held, held[1:]) if a.f == b.f)
