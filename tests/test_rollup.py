from datetime import date, datetime

from pyspark.sql import functions as F

from period_etl import daily_counts, filter_by_period, load_counts


def test_expected_rollup(trips):
    out = daily_counts(filter_by_period(trips, "2025-01", "ts"), "ts")
    assert out.columns == ["date", "period", "total_trips"]
    assert dict(out.dtypes) == {"date": "date", "period": "string", "total_trips": "bigint"}
    rows = sorted(tuple(r) for r in out.collect())
    assert rows == [(date(2025, 1, 1), "2025-01", 2), (date(2025, 1, 31), "2025-01", 1)]


def test_null_date_group_counts_zero(spark):
    df = spark.createDataFrame(
        [(datetime(2025, 1, 1), "2025-01"), (None, "2025-01"), (None, "2025-01")],
        "ts timestamp_ntz, period string")
    rows = {r.date: r.total_trips for r in daily_counts(df, "ts").collect()}
    assert rows == {date(2025, 1, 1): 1, None: 0}


def test_load_counts(spark, trips):
    tagged = trips.withColumn("period", F.when(F.col("id") < 4, "a").otherwise("b"))
    assert {r.period: r.n_rows for r in load_counts(tagged).collect()} == {"a": 3, "b": 4}
