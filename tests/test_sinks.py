import glob
import time

import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from period_etl import (
    ensure_namespace,
    read_partitioned,
    read_table,
    write_partitioned,
    write_table,
)
from period_etl.session import unique_name


@pytest.fixture()
def ns(spark, scratch):
    name = unique_name("t")
    ensure_namespace(spark, name, f"{scratch}/warehouse")
    return name


def keyed(spark):
    return spark.createDataFrame(
        [(1, "2025-01"), (2, None), (3, "2025-02"), (4, None), (5, "2025-01")],
        "id bigint, period string")


def test_namespace_created_once(spark, ns):
    ensure_namespace(spark, ns)
    assert spark.catalog.databaseExists(ns)


def test_null_keys_dropped_and_counted(spark, ns):
    t = f"{ns}.clean"
    report = write_table(keyed(spark), t)
    assert report.dropped_null_keys == 2
    assert sorted(r.id for r in spark.table(t).collect()) == [1, 3, 5]


def test_non_string_or_missing_key(spark, ns):
    with pytest.raises(ValueError):
        write_table(spark.createDataFrame([(1, 5)], "id bigint, period int"), f"{ns}.x")
    with pytest.raises(ValueError):
        write_table(spark.createDataFrame([(1,)], "id bigint"), f"{ns}.x")
    with pytest.raises(ValueError):
        write_partitioned(spark.createDataFrame([(1,)], "id bigint"), "/nonexistent/x")


def test_empty_append_creates_no_table(spark, ns):
    t = f"{ns}.empty"
    report = write_table(keyed(spark).limit(0), t)
    assert not report.written and report.dropped_null_keys == 0
    assert not spark.catalog.tableExists(t)


def test_append_by_name_and_rerun_doubles(spark, ns):
    t = f"{ns}.clean"
    df = keyed(spark).filter("period is not null")
    write_table(df, t)
    write_table(df.select("period", "id"), t)   # other column order
    rows = sorted(tuple(r) for r in spark.table(t).select("id", "period").collect())
    assert rows == sorted([(1, "2025-01"), (3, "2025-02"), (5, "2025-01")] * 2)


def test_table_overwrite_partitions(spark, ns):
    t = f"{ns}.clean"
    write_table(keyed(spark), t)
    again = spark.createDataFrame([(9, "2025-01"), (10, None)], "id bigint, period string")
    report = write_table(again, t, mode="overwrite_partitions")
    assert report.dropped_null_keys == 1
    rows = sorted(tuple(r) for r in spark.table(t).select("id", "period").collect())
    assert rows == [(3, "2025-02"), (9, "2025-01")]


def test_read_table_filter_prunes(spark, ns):
    t = f"{ns}.clean"
    write_table(keyed(spark), t)
    df = read_table(spark, t, "period", "2025-02")
    assert [r.id for r in df.collect()] == [3]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan and "= 2025-02" in plan
    assert read_table(spark, t).count() == 3
    with pytest.raises(AnalysisException):
        read_table(spark, f"{ns}.missing").count()


def test_path_sink_modes(spark, scratch):
    out = f"{scratch}/ds"
    df = keyed(spark).filter("period is not null")
    write_partitioned(df, out, mode="append")
    write_partitioned(df, out, mode="append")
    assert read_partitioned(spark, out).count() == 6
    write_partitioned(df.filter("period = '2025-01'"), out, mode="overwrite_partitions")
    got = read_partitioned(spark, out)
    assert {r.period: 0 for r in got.collect()}.keys() == {"2025-01", "2025-02"}
    assert got.filter("period = '2025-01'").count() == 2     # replaced
    assert got.filter("period = '2025-02'").count() == 2     # untouched
    assert read_partitioned(spark, out, periods="2025-02").count() == 2


def test_path_sink_keeps_or_drops_null_keys(spark, scratch):
    kept = f"{scratch}/kept"
    write_partitioned(keyed(spark), kept)
    assert read_partitioned(spark, kept).filter(F.col("period").isNull()).count() == 2
    dropped = f"{scratch}/dropped"
    report = write_partitioned(keyed(spark), dropped, drop_nulls=True)
    assert report.dropped_null_keys == 2
    assert read_partitioned(spark, dropped).count() == 3


def test_max_records_per_file(spark, scratch):
    out = f"{scratch}/rolled"
    df = spark.range(1000).withColumn("period", F.lit("2025-01")).coalesce(1)
    write_partitioned(df, out, max_records_per_file=300)
    files = glob.glob(out.replace("file:", "") + "/period=2025-01/*.parquet")
    assert len(files) == 4
    assert read_partitioned(spark, out).count() == 1000


def test_pruned_read_lists_only_wanted_folders(spark, scratch):
    out = f"{scratch}/ds"
    write_partitioned(keyed(spark).filter("period is not null"), out)
    df = read_partitioned(spark, out, periods=["2025-02", "1999-01"])
    assert all("period=2025-02" in f for f in df.inputFiles())
    assert [tuple(r) for r in df.collect()] == [(3, "2025-02")]
    assert df.columns == ["id", "period"]
    assert read_partitioned(spark, out, periods="1999-01").count() == 0


@pytest.mark.parametrize("tables", [False, True])
def test_a_task_of_one_period_holds_no_rows(spark, ns, scratch, tables):
    """Its file is open while it still reads: a sort by the key would take all rows first."""
    out = f"{scratch}/out"
    folder = out.removeprefix("file:")

    def rows(batches):
        for batch in batches:
            yield batch
        until = time.time() + 5
        while not (found := glob.glob(f"{folder}/**/part-*", recursive=True)) and time.time() < until:
            time.sleep(0.1)
        yield pa.record_batch([pa.array([len(found)], pa.int64())], schema=batch.schema)

    df = spark.range(0, 200_000, 1, 1).mapInArrow(rows, "id long").withColumn("period", F.when(F.col("id") >= 0, "2025-01"))
    if tables:
        write_table(df, f"{ns}.opened", folder=out)
    else:
        write_partitioned(df, out)
    stored = spark.read.parquet(out)
    assert stored.count() == 200_001 and stored.agg(F.sum("id")).first()[0] > 200_000 * 199_999 // 2


def test_a_task_of_more_keys_than_open_files(spark, scratch):
    df = spark.range(0, 10_000, 1, 1).withColumn("period", F.concat(F.lit("2025-"), F.lpad(F.col("id") % 12 + 1, 2, "0")))
    report = write_partitioned(df, f"{scratch}/out", max_records_per_file=300)
    stored = spark.read.option("basePath", f"{scratch}/out").parquet(f"{scratch}/out")
    assert report.rows == 10_000 and len(report.keys) == 12
    assert sorted(tuple(r) for r in stored.collect()) == sorted(tuple(r) for r in df.collect())
    assert stored.groupBy(F.col("_metadata.file_path")).count().agg(F.max("count")).first()[0] <= 300
