from period_etl.functions.periods import (
    PERIOD_PATTERN,
    PeriodError,
    date_col,
    entry_name_col,
    landing_period_at,
    landing_period_col,
    last_segment,
    month_key_col,
    month_text_col,
    parse_period,
    period_col,
    period_from_name,
    period_key_col,
    shared_period_offset,
    strip_scheme,
)

__all__ = [
    "PERIOD_PATTERN",
    "PeriodError",
    "date_col",
    "entry_name_col",
    "landing_period_at",
    "landing_period_col",
    "last_segment",
    "month_key_col",
    "month_text_col",
    "parse_period",
    "period_col",
    "period_from_name",
    "period_key_col",
    "shared_period_offset",
    "strip_scheme",
]
