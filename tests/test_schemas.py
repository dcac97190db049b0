import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string as kind

from period_etl import Storage, clean_all, clean_frame, read_landing, read_stage
from period_etl.sources.schemas import footer_columns, resolve, widened

EXACT = [("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("float", "double", "double"), ("int", "double", "double"),
         ("smallint", "float", "double"), ("decimal(10,2)", "decimal(12,4)", "decimal(12,4)"), ("decimal(10,0)", "decimal(5,3)", "decimal(13,3)"),
         ("int", "decimal(6,1)", "decimal(11,1)"), ("bigint", "decimal(5,2)", "decimal(22,2)"),
         ("struct<a:int,b:string>", "struct<a:bigint,c:date>", "struct<a:bigint,b:string,c:date>"), ("array<int>", "array<bigint>", "array<bigint>"),
         ("map<string,float>", "map<string,double>", "map<string,double>"), ("string", "string", "string")]
REFUSED = [("bigint", "double"), ("bigint", "float"), ("decimal(10,2)", "double"), ("decimal(38,0)", "decimal(10,2)"), ("int", "string"),
           ("struct<a:bigint>", "struct<a:double>"), ("array<int>", "int"), ("date", "timestamp_ntz"), ("map<string,int>", "map<string,string>")]


@pytest.mark.parametrize(("a", "b", "both"), EXACT)
def test_exact_types(spark, a, b, both):
    other = widened(kind(b), kind(a))
    assert widened(kind(a), kind(b)) == kind(both) and (other == kind(both) or sorted(other.names) == sorted(kind(both).names))


@pytest.mark.parametrize(("a", "b"), REFUSED)
def test_refused_types(spark, a, b):
    assert widened(kind(a), kind(b)) is None and widened(kind(b), kind(a)) is None


def _land(spark, root, kinds, value="7"):
    for i, k in enumerate(kinds):
        spark.sql(f"SELECT timestamp_ntz'2025-0{i + 1}-05 00:00:00' AS ts, CAST({value} AS {k}) AS v").coalesce(1).write.parquet(f"{root}/t_2025-0{i + 1}")
    return root


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("a", "b", "both"), EXACT[:9])
def test_one_scan_reads_the_wider_type(spark, scratch, a, b, both):
    df = clean_frame(spark, _land(spark, f"{scratch}/land", (a, b)), "ts")
    assert dict(df.dtypes)["v"] == both and [float(r.v) for r in df.collect()] == [7.0, 7.0] and plan(df).count("FileScan") == 1
    assert df.where("v = 7").count() == 2


def test_large_keys_are_never_rounded(spark, scratch):
    """2**53 + 1 has no double: mixed with doubles it raises, unless asked for; mixed with integers and decimals it stays."""
    root = _land(spark, f"{scratch}/a", ("bigint", "double"), 2**53 + 1)
    with pytest.raises(ValueError, match="v.*bigint.*t_2025-01.*double.*t_2025-02"):
        read_landing(spark, root)
    assert {r.v for r in read_landing(spark, root, inexact=True).collect()} == {float(2**53)}
    df = read_landing(spark, _land(spark, f"{scratch}/b", ("bigint", "decimal(20,2)"), 2**53 + 1))
    assert {int(r.v) for r in df.collect()} == {2**53 + 1}


def test_many_entries_are_resolved_by_one_query(spark, scratch):
    """A few hundred entries of three schemas: the footers are read in tasks, the jobs don't grow with the entries."""
    base = spark.range(300).select((F.col("id") % 3).alias("v"), "id")
    for i, k in enumerate(("int", "bigint", "smallint")):
        base.where(F.col("v") == i).withColumns({"v": F.col("v").cast(k), "entry": F.format_string("t%d_2025-01", "id")}).drop("id").repartition(
            1).write.mode("append").partitionBy("entry").parquet(f"{scratch}/land")
    paths = [f"{scratch}/land/entry=t{i}_2025-01" for i in range(300)]
    spark.sparkContext.setJobGroup("schemas", "schemas")
    schema, loose = resolve(footer_columns(spark, [f"file:{p}" for p in paths]), paths)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("schemas")
    assert schema.simpleString() == "struct<v:bigint>" and not loose and len(jobs) <= 5   # the stages of one adaptive query


def test_column_order_and_foreign_files(spark, scratch):
    """Files that Spark did not write: types come from the Parquet schema, unsigned ones as wider signed ones."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    os.makedirs(scratch)
    pq.write_table(pa.table({"a": pa.array([1], pa.uint32()), "t": pa.array([1_700_000_000_000_000], pa.timestamp("us"))}), f"{scratch}/x_2025-01.parquet")
    pq.write_table(pa.table({"b": pa.array(["s"]), "a": pa.array([2**40], pa.int64()), "z": pa.array([1], pa.timestamp("us", "UTC"))}), f"{scratch}/x_2025-02.parquet")
    schema, _ = resolve(footer_columns(spark, [f"file:{scratch}/x_2025-01.parquet", f"file:{scratch}/x_2025-02.parquet"]), ["x", "y"])
    assert schema.simpleString() == "struct<a:bigint,t:timestamp_ntz,b:string,z:timestamp>"
    assert {r.a for r in read_landing(spark, scratch).collect()} == {1, 2**40}


def test_stored_periods_of_different_types_read_back(spark, scratch):
    storage = Storage(root=f"{scratch}/out")
    for i, k in enumerate(("int", "bigint")):
        spark.sql(f"SELECT timestamp_ntz'2025-0{i + 1}-05 00:00:00' AS ts, CAST(7 AS {k}) AS v").write.parquet(f"{scratch}/land{i}/t_2025-0{i + 1}")
        clean_all(spark, f"{scratch}/land{i}", "ts", storage, "t")
    for wanted in (None, ["2025-01", "2025-02"]):
        df = read_stage(spark, storage, "t", "clean", wanted)
        assert dict(df.dtypes) == {"ts": "timestamp_ntz", "v": "bigint", "period": "string"}
        assert sorted((r.period, r.v) for r in df.collect()) == [("2025-01", 7), ("2025-02", 7)]
