"""Property tests against brute force on small random frames."""

from collections import Counter
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from period_etl import clean_tagged, daily_counts, filter_by_period

PERIODS = ["2024-12", "2025-01", "2025-02", "2025-13"]
BASE = datetime(2024, 12, 1)

# timestamps spread over three months, with month edges drawn often
edges = st.sampled_from([datetime(2025, 1, 1), datetime(2025, 2, 1),
                         datetime(2025, 1, 31, 23, 59, 59, 999999),
                         datetime(2024, 12, 31, 23, 59, 59, 999999)])
spread = st.integers(0, 92 * 24 * 3600 * 10**6 - 1).map(lambda us: BASE + timedelta(microseconds=us))
rows = st.lists(st.tuples(st.one_of(st.none(), edges, spread), st.sampled_from(PERIODS)),
                min_size=0, max_size=40)

SLOW = settings(max_examples=8, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])


def month(ts):
    return None if ts is None else f"{ts.year:04d}-{ts.month:02d}"


@SLOW
@given(rows)
def test_one_pass_clean_matches_brute_force(spark, data):
    df = spark.createDataFrame([(i, ts, p) for i, (ts, p) in enumerate(data)],
                               "id bigint, ts timestamp_ntz, period string")
    want = sorted(i for i, (ts, p) in enumerate(data) if month(ts) == p)
    assert sorted(r.id for r in clean_tagged(df, "ts").collect()) == want
    # and it equals the union of single-period cleans
    union = []
    for p in PERIODS:
        part = filter_by_period(df.filter(df.period == p).drop("period"), p, "ts")
        union += [r.id for r in part.collect()]
    assert sorted(union) == want


@SLOW
@given(rows)
def test_daily_counts_match_brute_force(spark, data):
    df = spark.createDataFrame([(ts, p) for ts, p in data], "ts timestamp_ntz, period string")
    want = Counter()
    for ts, p in data:
        want[(None if ts is None else ts.date(), p)] += 0 if ts is None else 1
    got = {(r.date, r.period): r.total_trips for r in daily_counts(df, "ts").collect()}
    assert got == dict(want)
