"""Benchmark: time the library's stages at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Fixtures (a landing set of ``lineitem`` with one entry per month, untimed)
are written once under the session's checkpoint folder. Each timed step runs
three times and the fastest run counts; frames are driven to completion with the
``noop`` sink or by their own writes. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from period_etl import (  # noqa: E402
    Storage,
    analytics_all,
    clean_all,
    clean_frame,
    daily_counts,
    filter_by_period,
    load_counts,
    read_landing,
    read_stage,
    run_all,
    scan_parquet,
)
from period_etl.session import local_session, scratch_dir, unique_name  # noqa: E402
from period_etl.testing import make_landing  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))
TS = "l_shipdate"


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    best = float("inf")
    for _ in range(REPEAT):
        t0 = time.perf_counter()
        fn()
        best = min(best, time.perf_counter() - t0)
    return round(best, 3)


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=max(CPUS, 8), app="period_etl-bench")
    base = scratch_dir(spark, "bench")
    t = lambda name: f"{SF_DIR}/{name}.parquet"
    land = make_landing(scan_parquet(spark, t("lineitem")), TS, f"{base}/landing", "lineitem")
    noop(scan_parquet(spark, t("orders")))  # warm the JVM

    def fresh_paths():
        return Storage(root=f"{base}/{unique_name('out')}")

    def fresh_tables():
        return Storage(namespace=unique_name("bench"), location=f"{base}/{unique_name('wh')}")

    kept = fresh_paths()
    clean_all(spark, land, TS, kept, "lineitem")
    periods = sorted(r.period for r in
                     read_stage(spark, kept, "lineitem", "clean").select("period").distinct().collect())

    q = {}
    q["q01_parquet_scan"] = timed(lambda: noop(scan_parquet(spark, t("lineitem"))))
    q["q02_clean_one_period"] = timed(
        lambda: noop(filter_by_period(scan_parquet(spark, t("lineitem")), "1997-05", TS)))
    q["q03_landing_scan"] = timed(lambda: noop(read_landing(spark, land)))
    q["q04_clean_all_periods"] = timed(lambda: noop(clean_frame(spark, land, TS)))
    q["q05_clean_write_paths"] = timed(
        lambda: clean_all(spark, land, TS, fresh_paths(), "lineitem"))
    q["q10_rerun_overwrite"] = timed(
        lambda: clean_all(spark, land, TS, kept, "lineitem", mode="overwrite_partitions"))
    q["q06_daily_counts"] = timed(lambda: daily_counts(
        filter_by_period(scan_parquet(spark, t("events")), "2024-01", "ts"), "ts").collect())
    q["q07_analytics_all_periods"] = timed(
        lambda: analytics_all(spark, kept, "lineitem", periods, TS))
    q["q09_clean_write_table"] = timed(
        lambda: clean_all(spark, land, TS, fresh_tables(), "lineitem", mode="append"))

    def flagship(storage):
        run_all(spark, land, TS, storage, "lineitem")
        read_stage(spark, storage, "lineitem", "analytics").collect()

    q["q12_daily_rollup"] = timed(lambda: flagship(fresh_paths()))
    q["q13_run_tables_load_counts"] = timed(lambda: (
        lambda s: (run_all(spark, land, TS, s, "lineitem", mode="append"),
                   load_counts(read_stage(spark, s, "lineitem", "clean")).collect()))(fresh_tables()))
    spark.stop()
    sf = os.path.basename(SF_DIR).replace("sf", "")
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(q.values()), 3),
        "unit": "sec",
        "queries": q,
        "flagship": "q12_daily_rollup",
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": CPUS,
        "dataset": "lineitem landing set, one entry per month",
    }))


if __name__ == "__main__":
    main()
