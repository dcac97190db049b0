from datetime import date, datetime

from pyspark.sql import functions as F

from period_etl import clean_tagged, filter_by_period


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_keeps_only_the_month(trips):
    out = filter_by_period(trips, "2025-01", "ts")
    assert ids(out) == [1, 2, 7]
    assert {r.period for r in out.select("period").collect()} == {"2025-01"}
    assert out.columns == ["id", "ts", "period"]


def test_impossible_month_gives_no_rows(trips):
    assert filter_by_period(trips, "2025-13", "ts").count() == 0
    assert filter_by_period(trips, "2025-00", "ts").count() == 0


def test_timestamp_with_zone_and_date_columns(spark, trips):
    ltz = trips.withColumn("ts", F.col("ts").cast("timestamp"))
    assert ids(filter_by_period(ltz, "2025-01", "ts")) == [1, 2, 7]
    d = spark.createDataFrame([(1, date(2025, 1, 31)), (2, date(2025, 2, 1)), (3, None)],
                              "id bigint, ts date")
    assert ids(filter_by_period(d, "2025-01", "ts")) == [1]


def test_december_rolls_into_next_year(spark):
    df = spark.createDataFrame([(1, datetime(2024, 12, 31, 23, 0)), (2, datetime(2025, 1, 1))],
                               "id bigint, ts timestamp_ntz")
    assert ids(filter_by_period(df, "2024-12", "ts")) == [1]


def test_clean_tagged_uses_each_rows_period(trips):
    tagged = trips.withColumn(
        "period", F.when(F.col("id").isin(3, 4), F.lit("2025-02")).otherwise(F.lit("2025-01")))
    # 3 is in February: kept; 4 is in December 2024: dropped.
    assert ids(clean_tagged(tagged, "ts")) == [1, 2, 3, 7]


def test_one_pass_equals_union_of_single_periods(trips):
    periods = ["2025-01", "2025-02", "2024-12", "2024-01"]
    tagged = None
    for p in periods:
        part = trips.withColumn("period", F.lit(p))
        tagged = part if tagged is None else tagged.unionByName(part)
    one_pass = clean_tagged(tagged, "ts")
    union = None
    for p in periods:
        part = filter_by_period(trips, p, "ts")
        union = part if union is None else union.unionByName(part)
    assert one_pass.exceptAll(union).count() == 0
    assert union.exceptAll(one_pass).count() == 0
