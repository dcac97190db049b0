"""Schemas recorded beside stored data."""

import json

import pytest
from pyspark.sql import functions as F

from period_etl import Storage, read_stage
from period_etl.plans.stages import write_stage
from period_etl.sources.recorded import FOLDER, record_schema, recorded_schema


def _rows(spark, ddl, *values):
    return spark.createDataFrame(list(values), ddl)


def _store(df, storage, mode="append"):
    write_stage(df, storage, "t", "clean", mode)


def _jobs(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = work()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_reads_need_no_footers(spark, scratch):
    storage = Storage(root=scratch, record_schemas=True)
    _store(_rows(spark, "id int, period string", (1, "2024-01")), storage)
    _store(_rows(spark, "id bigint, fee string, period string", (2**40, "x", "2024-02")), storage)
    want = [(1, None, "2024-01"), (2**40, "x", "2024-02")]
    by_record, jobs = _jobs(spark, "recorded", lambda: read_stage(spark, storage, "t", "clean"))
    by_footer, more = _jobs(spark, "footers", lambda: read_stage(spark, Storage(root=scratch), "t", "clean"))
    assert jobs == 0 < more
    assert by_record.columns == ["id", "fee", "period"] and dict(by_record.dtypes) == dict(by_footer.dtypes)
    for df in (by_record, by_footer):
        assert sorted(map(tuple, df.select("id", "fee", "period").collect())) == want
    one = read_stage(spark, storage, "t", "clean", "2024-01")
    assert [tuple(r) for r in one.collect()] == want[:1]
    assert "PartitionFilters: [isnotnull(period" in one._jdf.queryExecution().explainString(one._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_data_older_than_the_records_keeps_its_columns(spark, scratch):
    _store(_rows(spark, "id bigint, old string, period string", (1, "a", "2024-01")), Storage(root=scratch))
    storage = Storage(root=scratch, record_schemas=True)
    assert read_stage(spark, storage, "t", "clean").columns == ["id", "old", "period"]   # no record yet: the footers
    _store(_rows(spark, "id bigint, period string", (2, "2024-02")), storage)
    assert sorted(map(tuple, read_stage(spark, storage, "t", "clean").collect())) == [(1, "a", "2024-01"), (2, None, "2024-02")]


def test_one_file_for_each_schema_and_reruns_add_none(spark, scratch):
    storage = Storage(root=scratch, record_schemas=True)
    for _ in range(3):
        _store(_rows(spark, "id bigint, period string", (1, "2024-01")), storage, "overwrite_partitions")
    target = storage.target("t", "clean")
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target}/{FOLDER}")
    fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert [f.getPath().getName()[-5:] for f in fs.listStatus(fs_path)] == [".json"]
    assert read_stage(spark, storage, "t", "clean").count() == 1


def test_types_without_an_exact_common_one_leave_it_to_the_footers(spark, scratch):
    path = f"{scratch}/d"
    assert recorded_schema(spark, path) is None
    record_schema(spark, path, spark.createDataFrame([], "a bigint").schema)
    assert recorded_schema(spark, path).simpleString() == "struct<a:bigint>"
    record_schema(spark, path, spark.createDataFrame([], "a double").schema)
    assert recorded_schema(spark, path) is None
    storage = Storage(root=scratch, record_schemas=True)
    _store(_rows(spark, "id bigint, period string", (2**53 + 1, "2024-01")), storage)
    for _ in range(2):   # writing goes on
        _store(_rows(spark, "id double, period string", (0.5, "2024-02")), storage)
    with pytest.raises(ValueError, match="bigint"):
        read_stage(spark, storage, "t", "clean")


def test_null_keys_numbers_as_keys_and_nested_types(spark, scratch):
    storage = Storage(root=scratch, record_schemas=True)
    df = spark.range(3).select("id", F.struct(F.array("id").alias("xs")).alias("s"), F.element_at(F.array(F.lit("007"), F.lit("08"), F.lit(None)), (F.col("id") + 1).cast("int")).alias("period"))
    _store(df, storage)
    got = sorted(read_stage(spark, storage, "t", "clean").collect(), key=lambda r: r.id)
    assert [(r.id, r.s.xs, r.period) for r in got] == [(0, [0], "007"), (1, [1], "08"), (2, [2], None)]
    assert json.loads(recorded_schema(spark, storage.target("t", "clean")).json())["fields"][0]["name"] == "id"
    with pytest.raises(ValueError, match="root"):
        Storage(namespace="n", record_schemas=True)
