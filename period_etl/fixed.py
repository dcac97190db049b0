"""Fixed values.

These must stay as they are for results, names and layout to equal the
reference's, so that a user can switch over and find the same columns,
folders and tables.
"""

# Fixed values (must equal the reference's):
PERIOD_PATTERN = r"\d{4}-\d{2}"   # period in a landing entry's name; first match wins
PERIOD = "period"                 # partition column of the clean and analytics data
DATE = "date"                     # analytics: calendar date of the timestamp
TOTAL = "total_trips"             # analytics: non-null dates per (date, period), bigint
CLEAN = "clean"                   # clean stage: folder {root}/clean/{id}.parquet, table {id}_clean
ANALYTICS = "analytics"           # analytics stage: {root}/analytics/{id}.parquet, {id}_analytics
