from period_etl.plans.stages import (
    AnalyticsReport, RunResult, Storage, analytics_all, analytics_frame, analytics_period,
    clean_all, clean_frame, clean_period, read_stage, run_all, write_stage,
)

__all__ = ["AnalyticsReport", "RunResult", "Storage", "analytics_all", "analytics_frame",
           "analytics_period", "clean_all", "clean_frame", "clean_period", "read_stage",
           "run_all", "write_stage"]
