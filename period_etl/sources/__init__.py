from period_etl.sources.landing import LandingEntry, list_entry_names, list_landing, read_landing, read_landing_clean, tag_period
from period_etl.sources.parquet import key_filter, read_partitioned, scan_parquet
from period_etl.sources.tables import attach_table, read_table

__all__ = ["LandingEntry", "list_entry_names", "list_landing", "read_landing",
           "read_landing_clean", "tag_period",
           "key_filter", "read_partitioned", "scan_parquet", "read_table", "attach_table"]
