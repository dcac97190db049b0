import pytest
from pyspark.errors import PySparkException

from period_etl import clean_tagged, list_landing, read_landing, read_landing_clean
from period_etl.functions import PeriodError


def write_entry(df, path):
    df.coalesce(1).write.parquet(path)


def periods_by_id(df):
    return {r.id: r.period for r in df.select("id", "period").collect()}


def test_period_from_entry_not_part_file(spark, trips, scratch):
    root = f"{scratch}/landing"
    write_entry(trips, f"{root}/trips_2025-01.parquet")
    df = read_landing(spark, root)
    assert set(periods_by_id(df).values()) == {"2025-01"}
    assert df.count() == 7


def test_root_name_holding_a_date_is_ignored(spark, trips, scratch):
    root = f"{scratch}/landing_1999-09"
    write_entry(trips, f"{root}/trips_2025-01.parquet")
    assert set(periods_by_id(read_landing(spark, root)).values()) == {"2025-01"}


def test_first_match_in_entry_name(spark, trips, scratch):
    root = f"{scratch}/landing"
    write_entry(trips, f"{root}/x_12345-67_2025-01.parquet")
    assert set(periods_by_id(read_landing(spark, root)).values()) == {"2345-67"}


def test_many_entries_one_scan(spark, trips, scratch):
    root = f"{scratch}/landing"
    write_entry(trips.filter("id < 4"), f"{root}/trips_2025-01.parquet")
    write_entry(trips.filter("id >= 4"), f"{root}/trips_2025-02.parquet")
    df = read_landing(spark, root)
    got = periods_by_id(df)
    assert got == {1: "2025-01", 2: "2025-01", 3: "2025-01",
                   4: "2025-02", 5: "2025-02", 6: "2025-02", 7: "2025-02"}
    assert "Union" not in df._jdf.queryExecution().executedPlan().toString()


def test_no_period_in_name_is_an_error(spark, trips, scratch):
    root = f"{scratch}/landing"
    write_entry(trips, f"{root}/trips.parquet")
    with pytest.raises(PeriodError):
        read_landing(spark, root)


def test_unlisted_entry_without_period_fails_at_run_time(spark, trips, scratch):
    from pyspark.sql import functions as F

    from period_etl.sources.landing import tag_period
    root = f"{scratch}/landing"
    write_entry(trips, f"{root}/trips.parquet")
    df = spark.read.parquet(f"{root}/trips.parquet").select(
        "*", F.col("_metadata.file_path").alias("fp"))
    with pytest.raises(PySparkException):
        tag_period(df, root, "fp").collect()


def test_duplicate_period(spark, trips, scratch):
    root = f"{scratch}/landing"
    write_entry(trips.filter("id = 1"), f"{root}/a_2025-01.parquet")
    write_entry(trips.filter("id = 2"), f"{root}/b_2025-01.parquet")
    with pytest.raises(ValueError):
        read_landing(spark, root)
    kept = read_landing(spark, root, on_duplicate="last")
    assert [r.id for r in kept.collect()] == [2]
    # explicit order: the later entry wins
    kept = read_landing(spark, root, entries=["b_2025-01.parquet", "a_2025-01.parquet"],
                        on_duplicate="last")
    assert [r.id for r in kept.collect()] == [1]


def test_list_landing_skips_hidden(spark, trips, scratch):
    root = f"{scratch}/landing"
    write_entry(trips, f"{root}/trips_2025-01.parquet")
    write_entry(trips, f"{root}/_tmp_2025-02.parquet")
    assert [e.period for e in list_landing(spark, root)] == ["2025-01"]


def test_entries_given_as_urls(spark, trips, scratch):
    root = f"{scratch}/landing"
    write_entry(trips.filter("id = 1"), f"{root}/trips_2025-01.parquet")
    write_entry(trips.filter("id = 3"), f"{root}/trips_2025-02.parquet")
    urls = ["https://example.invalid/data/trips_2025-02.parquet"]
    df = read_landing(spark, root, entries=urls)
    assert [(r.id, r.period) for r in df.collect()] == [(3, "2025-02")]


def test_fused_clean_equals_tag_then_clean(spark, trips, scratch):
    root = f"{scratch}/landing"
    write_entry(trips.filter("id < 4"), f"{root}/trips_2025-01.parquet")
    write_entry(trips.filter("id >= 4"), f"{root}/trips_2024-12.parquet")
    write_entry(trips, f"{root}/x_2024-01_2025-02.parquet")
    fused = read_landing_clean(spark, root, "ts")
    plain = clean_tagged(read_landing(spark, root), "ts")
    assert fused.columns == plain.columns
    assert fused.exceptAll(plain).count() == 0 and plain.exceptAll(fused).count() == 0
    assert sorted((r.id, r.period) for r in fused.collect()) == [
        (1, "2025-01"), (2, "2025-01"), (4, "2024-12"), (5, "2024-01")]


def test_root_with_space_and_relative_entries(spark, trips, scratch):
    root = f"{scratch}/land ing"
    write_entry(trips.filter("id < 4"), f"{root}/trips 2025-01.parquet")
    got = periods_by_id(read_landing(spark, root))
    assert got == {1: "2025-01", 2: "2025-01", 3: "2025-01"}
    assert sorted(r.id for r in read_landing_clean(spark, root, "ts").collect()) == [1, 2]


def test_mixed_name_layouts_use_the_regex_path(spark, trips, scratch):
    from period_etl.functions import shared_period_offset
    assert shared_period_offset([("a_2025-01.p", "2025-01"), ("b_2025-02.p", "2025-02")]) == 2
    assert shared_period_offset([("a_2025-01.p", "2025-01"), ("bb_2025-02.p", "2025-02")]) is None
    assert shared_period_offset([("a b2025-01", "2025-01"), ("a_b2025-02", "2025-02")]) is None
    root = f"{scratch}/landing"
    write_entry(trips.filter("id < 4"), f"{root}/t_2025-01.parquet")
    write_entry(trips.filter("id >= 4"), f"{root}/trips_2024-12.parquet")
    fused = read_landing_clean(spark, root, "ts")
    assert sorted((r.id, r.period) for r in fused.collect()) == [
        (1, "2025-01"), (2, "2025-01"), (4, "2024-12")]
    assert periods_by_id(read_landing(spark, root)) == {
        1: "2025-01", 2: "2025-01", 3: "2025-01", 4: "2024-12", 5: "2024-12",
        6: "2024-12", 7: "2024-12"}


def test_missing_root(spark, scratch):
    with pytest.raises((FileNotFoundError, PeriodError)):
        read_landing(spark, f"{scratch}/nowhere")


def test_escaped_characters_before_the_period(spark, trips, scratch):
    # In the file URI the space becomes %20, and "%2012-20" must not be read
    # as a period: the entry name's own first match is 2025-01.
    root = f"{scratch}/landing"
    write_entry(trips.filter("id < 4"), f"{root}/x 12-2025-01.parquet")
    write_entry(trips.filter("id >= 4"), f"{root}/trips_2024-12.parquet")
    assert set(periods_by_id(read_landing(spark, root)).values()) == {"2025-01", "2024-12"}
    assert sorted(r.id for r in read_landing_clean(spark, root, "ts").collect()) == [1, 2, 4]


def test_non_ascii_root_and_entry(spark, trips, scratch):
    root = f"{scratch}/données"
    write_entry(trips.filter("id < 4"), f"{root}/relevé_2025-01.parquet")
    write_entry(trips.filter("id >= 4"), f"{root}/relevé_2024-12.parquet")
    assert set(periods_by_id(read_landing(spark, root)).values()) == {"2025-01", "2024-12"}
    assert sorted(r.id for r in read_landing_clean(spark, root, "ts").collect()) == [1, 2, 4]
