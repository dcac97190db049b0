"""Drifting schemas, emptied periods, missing targets, one-pass table writes and shared folders."""

import os

import pytest
from pyspark.sql import functions as F

from period_etl import (
    Storage,
    analytics_all,
    analytics_period,
    clean_all,
    clean_frame,
    filter_by_period,
    read_stage,
    run_all,
    scan_parquet,
    write_table,
)
from period_etl.plans.config_run import load_config
from period_etl.session import checkpoint_root, unique_name
from period_etl.streaming import stream_landing


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def month(trips, n, **columns):
    df = trips.where(F.month("ts") == n).where("year(ts) = 2025")
    for name, value in columns.items():
        df = df.withColumn(name, value)
    return df.coalesce(1)


def test_new_column_in_a_later_entry_is_one_scan(spark, scratch, trips):
    month(trips, 1).write.parquet(f"{scratch}/land/t_2025-01.parquet")
    month(trips, 2, fee=F.lit(7)).write.parquet(f"{scratch}/land/t_2025-02.parquet")
    df = clean_frame(spark, f"{scratch}/land", "ts")
    assert {(r.period, r.fee) for r in df.collect()} == {("2025-01", None), ("2025-02", 7)}
    assert plan(df).count("FileScan") == 1 and "Exchange" not in plan(df)


def test_type_drift_is_one_scan_for_each_schema(spark, scratch, trips):
    month(trips, 1).write.parquet(f"{scratch}/land/t_2025-01.parquet")
    month(trips, 2, id=F.col("id").cast("double")).write.parquet(f"{scratch}/land/t_2025-02.parquet")
    with pytest.raises(ValueError, match="id.*bigint.*t_2025-01.*double.*t_2025-02"):   # above 2**53 doubles skip integers
        clean_frame(spark, f"{scratch}/land", "ts")
    df = clean_frame(spark, f"{scratch}/land", "ts", inexact=True)
    assert dict(df.dtypes)["id"] == "double" and {r.id for r in df.collect()} == {1.0, 2.0, 7.0, 3.0}
    assert plan(df).count("FileScan") == 2 and "Exchange" not in plan(df)


def test_types_that_do_not_widen_name_both_entries(spark, scratch, trips):
    month(trips, 1).write.parquet(f"{scratch}/land/t_2025-01.parquet")
    month(trips, 2, id=F.col("id").cast("string")).write.parquet(f"{scratch}/land/t_2025-02.parquet")
    with pytest.raises(ValueError, match="t_2025-01.*t_2025-02"):
        clean_frame(spark, f"{scratch}/land", "ts")


def test_column_added_by_a_later_run_is_read_back(spark, scratch, trips):
    storage = Storage(root=f"{scratch}/out")
    month(trips, 1).write.parquet(f"{scratch}/a/t_2025-01.parquet")
    month(trips, 2, fee=F.lit(7)).write.parquet(f"{scratch}/b/t_2025-02.parquet")
    for land in "ab":
        clean_all(spark, f"{scratch}/{land}", "ts", storage, "t")
    assert {(r.period, r.fee) for r in read_stage(spark, storage, "t", "clean").collect()} == {("2025-01", None), ("2025-02", 7)}


def test_table_overwrite_refuses_other_columns(spark, scratch, trips):
    storage = Storage(namespace=unique_name("cols"), location=f"{scratch}/wh")
    spark.sql(f"CREATE DATABASE {storage.namespace}")
    rows, table = trips.withColumn("period", F.lit("2025-01")), storage.target("t", "clean")
    write_table(rows, table)
    with pytest.raises(ValueError, match="fee"):
        write_table(rows.withColumn("fee", F.lit(1)), table, mode="overwrite_partitions")
    with pytest.raises(ValueError, match="ts"):
        write_table(rows.drop("ts"), table, mode="overwrite_partitions")


@pytest.mark.parametrize("tables", [False, True])
def test_analytics_of_a_missing_target_is_an_error(spark, scratch, tables):
    storage = Storage(namespace=unique_name("none"), location=f"{scratch}/wh") if tables else Storage(root=f"{scratch}/out")
    with pytest.raises(FileNotFoundError, match="mistyped"):
        analytics_all(spark, storage, "mistyped", ["2025-01"], "ts")


def test_period_without_rows_in_an_existing_target(spark, scratch, trips):
    storage = Storage(root=f"{scratch}/out")
    month(trips, 1).write.parquet(f"{scratch}/land/t_2025-01.parquet")
    clean_all(spark, f"{scratch}/land", "ts", storage, "t")
    assert not analytics_period(spark, storage, "t", "2024-07", "ts").write.written


def _jobs(spark, action):
    group = unique_name("jobs")
    spark.sparkContext.setJobGroup(group, group)
    action()
    spark.sparkContext.setJobGroup("", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_a_new_table_takes_the_jobs_of_an_existing_one(spark, scratch, trips):
    rows = trips.groupBy("id").agg(F.max("ts").alias("ts")).withColumn("period", F.lit("2025-01"))
    spark.sql(f"CREATE DATABASE {(name := unique_name('once'))}")
    first = _jobs(spark, lambda: write_table(rows, f"{name}.t", folder=f"{scratch}/t"))
    again = _jobs(spark, lambda: write_table(rows, f"{name}.t"))
    assert first == again


def test_empty_first_write_leaves_nothing(spark, scratch, trips):
    spark.sql(f"CREATE DATABASE {(name := unique_name('nil'))}")
    empty = filter_by_period(trips, "2030-01", "ts")
    assert not write_table(empty, f"{name}.t", folder=f"{scratch}/t").written
    assert not spark.catalog.tableExists(f"{name}.t") and not os.path.exists(f"{scratch}/t".replace("file:", ""))


def test_tables_of_an_existing_namespace_stay_under_the_location(spark, scratch, trips):
    month(trips, 1).write.parquet(f"{scratch}/land/t_2025-01.parquet")
    name = unique_name("t")
    storage = Storage(namespace="default", location=f"{scratch}/wh")
    run_all(spark, f"{scratch}/land", "ts", storage, name)
    assert os.path.isdir(f"{scratch}/wh/{name}_clean/period=2025-01".replace("file:", ""))
    for stage in ("clean", "analytics"):   # what a second session's catalog lacks
        spark.sql(f"DROP TABLE {storage.target(name, stage)}")
    assert read_stage(spark, storage, name, "clean").count() == 3
    assert run_all(spark, f"{scratch}/land", "ts", storage, name).loaded_rows == {"2025-01": 3}


def test_names_with_pattern_characters(spark, scratch, trips):
    month(trips, 1).write.parquet(f"{scratch}/l[a]nd/trips[a]_2025-01.parquet")
    month(trips, 2).write.parquet(f"{scratch}/l[a]nd/t{{x}}*?_2025-02.parquet")
    got = clean_frame(spark, f"{scratch}/l[a]nd", "ts").groupBy("period").count().collect()
    assert {(r.period, r["count"]) for r in got} == {("2025-01", 3), ("2025-02", 1)}


def test_timestamp_column_in_other_case(spark, trips):
    assert filter_by_period(trips, "2025-01", "TS").count() == 3


def test_rebalanced_storage(spark, scratch, trips):
    month(trips, 1).write.parquet(f"{scratch}/land/t_2025-01.parquet")
    storage = Storage(root=f"{scratch}/out", rebalance=True)
    assert run_all(spark, f"{scratch}/land", "ts", storage, "t").loaded_rows == {"2025-01": 3}


def test_stream_needs_a_stable_checkpoint(spark, scratch, trips):
    with pytest.raises(ValueError, match="checkpoint_location"):
        stream_landing(spark, f"{scratch}", trips.schema, "ts", Storage(namespace="n"), "t")


def test_shared_folder_is_demanded_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_iceberg_config_warns(tmp_path, caplog):
    (tmp_path / "c.toml").write_text(
        'data_dir = "/d"\n[dataset]\ndata_id = "x"\ntimestamp_column = "ts"\nurls = ["h/x_2025-01.parquet"]\n'
        '[iceberg]\nenabled = true\nnamespace = "n"\ncatalog_uri = "sqlite://c"\n')
    assert load_config(str(tmp_path / "c.toml")).storage.namespace == "n"
    assert "catalog_uri is ignored" in caplog.text
