import os
import threading
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from period_etl import Storage, read_stage, run_all, write_table
from period_etl.operators import sinks
from period_etl.operators.lease import NAME, Lease, LeaseHeld, single_writer
from period_etl.operators.sinks import committed_runs, vacuum_runs
from period_etl.session import unique_name


@pytest.fixture()
def land(trips, scratch):
    for n, ids in (("2025-01", "id in (1, 2, 7)"), ("2025-02", "id = 3")):
        trips.where(ids).coalesce(1).write.parquet(f"{scratch}/land/t_{n}")
    return f"{scratch}/land"


def swapping(scratch):
    return Storage(namespace=unique_name("swap"), location=f"{scratch}/wh", swap=True)


def ids(spark, storage):
    return sorted((r.period, r.id) for r in read_stage(spark, storage, "t", "clean").collect())


FIRST = [("2025-01", 1), ("2025-01", 2), ("2025-01", 7), ("2025-02", 3)]


def test_periods_are_swapped_and_found_again(spark, trips, scratch, land):
    storage = swapping(scratch)
    run_all(spark, land, "ts", storage, "t")
    assert ids(spark, storage) == FIRST
    trips.where("id = 1").coalesce(1).write.mode("overwrite").parquet(f"{land}/t_2025-01")
    trips.where("id = 4").coalesce(1).write.mode("overwrite").parquet(f"{land}/t_2025-02")   # no row of its own month any more
    run_all(spark, land, "ts", storage, "t")
    for each in (storage, swapping(scratch)):   # in this session's table, and attached anew
        assert ids(spark, each) == [("2025-01", 1)]
        assert [(r.period, r.total_trips) for r in read_stage(spark, each, "t", "analytics").collect()] == [("2025-01", 1)]
    gone = vacuum_runs(spark, storage.target("t", "clean"), "period", f"{scratch}/wh/t_clean")
    assert len(gone) == 2 and ids(spark, storage) == ids(spark, swapping(scratch)) == [("2025-01", 1)]
    run_all(spark, land, "ts", storage, "t")
    assert ids(spark, storage) == [("2025-01", 1)]


def test_a_write_that_dies_leaves_the_old_rows(spark, scratch, land, monkeypatch):
    storage = swapping(scratch)
    run_all(spark, land, "ts", storage, "t")
    table, folder = storage.target("t", "clean"), f"{scratch}/wh/t_clean"
    rows = spark.table(table)
    lost = rows.withColumn("id", F.when(F.col("id") == 7, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id") + 100))
    with pytest.raises(Exception, match="lost"):
        write_table(lost, table, mode="swap_partitions", folder=folder)
    assert ids(spark, storage) == ids(spark, swapping(scratch)) == FIRST and committed_runs(spark, folder) == []
    calls = []
    swap = sinks.swap_partitions

    def dies(spark, table, key, run, values):   # between two periods
        swap(spark, table, key, run, list(values)[:1])
        calls.append(run)
        raise RuntimeError("died")

    monkeypatch.setattr(sinks, "swap_partitions", dies)
    with pytest.raises(RuntimeError, match="died"):
        write_table(rows.withColumn("id", F.col("id") + 100), table, mode="swap_partitions", folder=folder)
    assert ids(spark, storage) == [("2025-01", 101), ("2025-01", 102), ("2025-01", 107), ("2025-02", 3)]   # each whole


def test_a_reader_of_old_rows_goes_on(spark, trips, scratch, land):
    """Files that were read when a period was swapped stay until they are vacuumed."""
    storage = swapping(scratch)
    run_all(spark, land, "ts", storage, "t")
    files = read_stage(spark, storage, "t", "clean").inputFiles()
    run_all(spark, land, "ts", storage, "t")
    assert spark.read.parquet(*files).count() == 4
    vacuum_runs(spark, storage.target("t", "clean"), "period", f"{scratch}/wh/t_clean")
    assert ids(spark, storage) == FIRST and not any(os.path.exists(f.removeprefix("file:")) for f in files)


def test_swap_needs_a_place(spark, trips, scratch):
    with pytest.raises(ValueError, match="location"):
        Storage(namespace="x", swap=True)
    with pytest.raises(ValueError, match="folder"):
        write_table(trips.withColumn("period", F.lit("2025-01")), "x.t", mode="swap_partitions")


def test_the_second_of_two_runs_raises(spark, scratch, land):
    storage, errors, inside, go = Storage(root=f"{scratch}/out"), [], threading.Event(), threading.Event()

    def first():
        with single_writer(spark, f"{scratch}/out/_leases/t", 60):
            inside.set()
            go.wait(60)

    one = threading.Thread(target=first)
    one.start()
    inside.wait(60)
    with pytest.raises(LeaseHeld):
        run_all(spark, land, "ts", storage, "t", lease_seconds=60)
    assert not os.path.exists(f"{scratch}/out/clean")
    go.set()
    one.join()
    run_all(spark, land, "ts", storage, "t", lease_seconds=60)
    assert ids(spark, storage) == FIRST and not errors


def test_of_many_one_gets_the_lease(spark, scratch):
    got, held = [], []

    def run():
        try:
            Lease(spark, f"{scratch}/l", 60).take()
            got.append(1)
        except LeaseHeld:
            held.append(1)

    for round in range(3):   # no lease yet, one given back, one of a run that died
        if round == 1:
            with pytest.raises(LeaseHeld):
                Lease(spark, f"{scratch}/l", 60).take()
            Path(f"{scratch}/l", f"{NAME}{0:012d}").write_text('{"holder": "x", "until": 0}')
        if round == 2:
            Path(f"{scratch}/l", f"{NAME}{2:012d}").write_text('{"holder": "dead", "until": 1}')
        got.clear()
        threads = [threading.Thread(target=run) for _ in range(8)]
        [t.start() for t in threads]
        [t.join() for t in threads]
        assert len(got) == 1


def test_a_lease_runs_out_and_is_renewed(spark, scratch):
    first, second = Lease(spark, f"{scratch}/l", 0.5), Lease(spark, f"{scratch}/l", 60)
    first.take()
    time.sleep(0.3)
    first.renew()
    time.sleep(0.3)
    with pytest.raises(LeaseHeld):
        second.take()
    time.sleep(0.4)
    second.take()
    with pytest.raises(LeaseHeld, match="taken over"):
        first.renew()
    first.give_back()   # not its own any more
    assert second._held(second.number) == second.holder
    second.give_back()
    with single_writer(spark, f"{scratch}/l", 60) as third:
        assert third.number == second.number + 1
