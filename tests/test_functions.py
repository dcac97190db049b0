import pytest

from period_etl.functions import (
    PeriodError,
    last_segment,
    parse_period,
    period_from_name,
    strip_scheme,
)


@pytest.mark.parametrize("name,period", [
    ("trips_2025-01.parquet", "2025-01"),
    ("yellow_tripdata_2025-03.parquet", "2025-03"),
    ("x_12345-67_2025-01.parquet", "2345-67"),   # first match wins
    ("entry=orders_1996-03", "1996-03"),
    ("trips_2025-13.parquet", "2025-13"),         # impossible month still parses
])
def test_period_from_name(name, period):
    assert period_from_name(name) == period


def test_no_period_is_an_error():
    with pytest.raises(PeriodError):
        period_from_name("trips.parquet")


def test_last_segment():
    assert last_segment("https://host/trip-data/yellow_tripdata_2025-01.parquet") == \
        "yellow_tripdata_2025-01.parquet"
    assert last_segment("/a/b/trips_2025-01.parquet/") == "trips_2025-01.parquet"
    with pytest.raises(PeriodError):
        last_segment("/")


def test_parse_period():
    assert parse_period("2025-01") == (2025, 1)
    assert parse_period("2025-13") == (2025, 13)
    assert parse_period("2025-01-05") == (2025, 1)
    for bad in ("202501", "20x5-01", "2025-ab", ""):
        with pytest.raises(PeriodError):
            parse_period(bad)


def test_strip_scheme():
    assert strip_scheme("file:///tmp/a/") == "/tmp/a"
    assert strip_scheme("file:/tmp/a") == "/tmp/a"
    assert strip_scheme("/tmp/a") == "/tmp/a"
    assert strip_scheme("s3a://bucket/land") == "bucket/land"


def test_uri_escaping_matches_file_uris():
    from period_etl.functions.periods import _uri_escape, names_are_plain
    assert _uri_escape("/tmp/land ing/") == "/tmp/land%20ing/"
    assert _uri_escape("/tmp/données/") == "/tmp/données/"       # kept as is
    assert _uri_escape("/a/100%/") == "/a/100%25/"
    assert names_are_plain(["trips_2025-01.parquet", "entry=orders_1996-03"])
    assert not names_are_plain(["x 12-2025-01.parquet"])
    assert not names_are_plain(["relevé_2025-01.parquet"])
