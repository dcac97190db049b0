import os

import pytest
from pyspark.sql import functions as F

from period_etl import Storage, clean_all, read_stage, scan_parquet
from period_etl.operators.sinks import file_sizes, rows_for_bytes
from period_etl.plans import changed
from period_etl.plans.changed import fingerprints, read_ledger, run_changed
from period_etl.session import unique_name


@pytest.fixture()
def landing(spark, trips, scratch):
    for n, ids in (("2025-01", "id in (1, 2, 7)"), ("2025-02", "id = 3"), ("2024-12", "id = 4")):
        trips.where(ids).coalesce(1).write.parquet(f"{scratch}/land/t_{n}.parquet")
    return f"{scratch}/land"


@pytest.mark.parametrize("tables", [False, True])
def test_only_new_and_changed_entries_are_done(spark, trips, scratch, landing, tables):
    storage = Storage(namespace=unique_name("chg"), location=f"{scratch}/wh") if tables else Storage(root=f"{scratch}/out")
    assert run_changed(spark, landing, "ts", storage, "t").entries == ["t_2024-12.parquet", "t_2025-01.parquet", "t_2025-02.parquet"]
    again = run_changed(spark, landing, "ts", storage, "t")
    assert again.entries == [] and again.result is None
    trips.where("id = 3").coalesce(1).write.mode("append").parquet(f"{landing}/t_2025-02.parquet")
    trips.where("id = 5").coalesce(1).write.parquet(f"{landing}/t_2024-01.parquet")
    assert run_changed(spark, landing, "ts", storage, "t").entries == ["t_2024-01.parquet", "t_2025-02.parquet"]
    assert sorted(r.id for r in read_stage(spark, storage, "t", "clean").collect()) == [1, 2, 3, 3, 4, 5, 7]
    assert {(r.entry, r.run) for r in read_ledger(spark, storage, "t").collect()} == {
        ("t_2024-12.parquet", 0), ("t_2025-01.parquet", 0), ("t_2025-02.parquet", 0), ("t_2024-01.parquet", 1), ("t_2025-02.parquet", 1)}


def test_a_touched_file_counts_as_changed(spark, scratch, landing):
    storage = Storage(root=f"{scratch}/out")
    run_changed(spark, landing, "ts", storage, "t")
    folder = f"{landing}/t_2025-02.parquet"
    part = next(f for f in os.listdir(folder) if f.startswith("part-"))
    os.utime(f"{folder}/{part}", (1, 1))
    assert run_changed(spark, landing, "ts", storage, "t").entries == ["t_2025-02.parquet"]
    os.utime(f"{folder}/{part}", (2, 2))
    assert run_changed(spark, landing, "ts", storage, "t").entries == ["t_2025-02.parquet"]
    assert run_changed(spark, landing, "ts", storage, "t").entries == []


def test_a_failed_run_is_done_again(spark, scratch, landing, monkeypatch):
    storage = Storage(root=f"{scratch}/out")
    monkeypatch.setattr(changed, "run_all", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_changed(spark, landing, "ts", storage, "t")
    monkeypatch.undo()
    assert len(run_changed(spark, landing, "ts", storage, "t").entries) == 3


def test_fingerprints_open_no_file(spark, landing):
    shown = fingerprints(spark, landing)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in shown.split("ReadSchema")[1].split(">")[0]


def test_files_are_bounded_in_bytes(spark, scratch):
    """Rows of uneven length, and a source that packs its rows better than the sorted target's files do."""
    rows = spark.range(40_000).select((F.timestamp_seconds(F.lit(1_735_700_000) + F.col("id") % 2_000_000)).cast("timestamp_ntz").alias("ts"),
                                      F.when(F.col("id") > 20_000, F.sha2(F.col("id").cast("string"), 256)).otherwise(F.lit("x")).alias("s"))
    rows.coalesce(1).write.parquet(f"{scratch}/land/t_2025-01.parquet")
    for tables in (False, True):
        storage = Storage(namespace=unique_name("bytes"), location=f"{scratch}/wh", max_bytes_per_file=100_000) if tables else \
            Storage(root=f"{scratch}/out", max_bytes_per_file=100_000)
        clean_all(spark, f"{scratch}/land", "ts", storage, "t")
        folder = f"{scratch}/wh/t_clean" if tables else storage.target("t", "clean")
        sizes = [r.length for r in file_sizes(spark, [folder]).collect()]
        assert max(sizes) <= 110_000 and len(sizes) > 5
        assert read_stage(spark, storage, "t", "clean").count() == scan_parquet(spark, f"{scratch}/land/t_2025-01.parquet").count()


def test_rows_for_bytes_of_nothing(spark, scratch):
    spark.range(0).write.parquet(f"{scratch}/none")
    assert rows_for_bytes(spark, [f"{scratch}/none"], 1000) == 0
