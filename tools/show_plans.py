"""Write the formatted physical plans of the main stages to docs/PLANS.md.

    python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from period_etl import (  # noqa: E402
    Storage,
    analytics_frame,
    clean_all,
    clean_frame,
    filter_by_period,
    read_stage,
    read_table,
    scan_parquet,
)
from period_etl.operators.rollup import daily_counts  # noqa: E402
from period_etl.session import local_session, scratch_dir, unique_name  # noqa: E402
from period_etl.testing import make_landing  # noqa: E402


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    # scratch folders differ per run; keep the plans stable
    return re.sub(r"period_etl/[a-z]+-[0-9a-f]{12}", "period_etl/<scratch>", text)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    base = scratch_dir(spark, "plans")
    land = make_landing(scan_parquet(spark, f"{sf}/orders.parquet"), "o_orderdate",
                        f"{base}/landing", "orders")
    paths = Storage(root=f"{base}/out")
    tables = Storage(namespace=unique_name("plans"), location=f"{base}/wh")
    periods, _ = clean_all(spark, land, "o_orderdate", paths, "orders")
    clean_all(spark, land, "o_orderdate", tables, "orders")
    sections = [
        ("L1/F1: one-period clean (range pushed to Parquet)",
         filter_by_period(scan_parquet(spark, f"{sf}/orders.parquet"), "1996-03", "o_orderdate")),
        ("L2: one-pass clean of every landing entry (no exchange)",
         clean_frame(spark, land, "o_orderdate")),
        ("S3: partitioned read of one period (only that folder listed)",
         read_stage(spark, paths, "orders", "clean", "1996-03")),
        ("S4: table read with period filter (partition pruning)",
         read_table(spark, tables.target("orders", "clean"), "period", "1997-05")),
        ("L4/A1: daily counts of two periods (partial + final aggregate, one exchange)",
         analytics_frame(spark, paths, "orders", periods[10:12], "o_orderdate")),
        ("A1 on events: month filter + daily counts",
         daily_counts(filter_by_period(scan_parquet(spark, f"{sf}/events.parquet"),
                                       "2024-01", "ts"), "ts")),
    ]
    out = ["# Physical plans", "",
           f"Generated by `python tools/show_plans.py {sf}` (Spark {spark.version}).", ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", formatted(df).strip(), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                        "docs", "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    spark.stop()
    print(path)


if __name__ == "__main__":
    main()
