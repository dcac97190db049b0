from period_etl.operators.clean import clean_tagged, filter_by_period, in_month
from period_etl.operators.rollup import daily_counts, load_counts, with_date
from period_etl.operators.sinks import (
    MODES, WriteReport, check_key, drop_null_keys, ensure_namespace, table_exists,
    write_partitioned, write_table,
)

__all__ = ["clean_tagged", "filter_by_period", "in_month", "daily_counts", "load_counts",
           "with_date", "MODES", "WriteReport", "check_key", "drop_null_keys",
           "ensure_namespace", "table_exists", "write_partitioned", "write_table"]
