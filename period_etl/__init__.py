"""period_etl: period-partitioned batch ETL on Spark.

Landing sets of monthly Parquet files are cleaned to the rows of their own
month, stored partitioned by ``period`` (a Parquet dataset or a catalog
table), and rolled up to daily row counts per period. Every step is a plain
function over DataFrames; each stage is one Spark job for all periods.
"""

from period_etl.functions import (
    PERIOD_PATTERN,
    PeriodError,
    last_segment,
    parse_period,
    period_from_name,
)
from period_etl.operators.clean import clean_tagged, filter_by_period, in_month
from period_etl.operators.rollup import daily_counts, load_counts, with_date
from period_etl.operators.sinks import (
    WriteReport,
    check_key,
    drop_null_keys,
    ensure_namespace,
    write_partitioned,
    write_table,
)
from period_etl.plans.stages import (
    Storage,
    analytics_all,
    analytics_frame,
    analytics_period,
    clean_all,
    clean_frame,
    clean_period,
    read_stage,
    run_all,
)
from period_etl.sources.landing import (
    LandingEntry,
    list_landing,
    read_landing,
    read_landing_clean,
)
from period_etl.sources.parquet import key_filter, read_partitioned, scan_parquet
from period_etl.sources.tables import attach_table, read_table

__all__ = [
    "PERIOD_PATTERN", "PeriodError", "last_segment", "parse_period", "period_from_name",
    "clean_tagged", "filter_by_period", "in_month",
    "daily_counts", "load_counts", "with_date",
    "WriteReport", "check_key", "drop_null_keys", "ensure_namespace",
    "write_partitioned", "write_table",
    "Storage", "analytics_all", "analytics_frame", "analytics_period", "clean_all",
    "clean_frame", "clean_period", "read_stage", "run_all",
    "LandingEntry", "list_landing", "read_landing", "read_landing_clean",
    "key_filter", "read_partitioned", "scan_parquet", "read_table", "attach_table",
]
