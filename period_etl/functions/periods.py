"""Period helpers: names, parsing and row-level period expressions.

A *period* is a calendar month written ``YYYY-MM``. It is taken from the name
of a landing entry (P5, P6), parsed into year and month (P7) and compared with
a row's timestamp (P8, P9). Driver-side helpers work on the handful of entry
names; the Column helpers run inside whole-stage codegen on every row.
"""

from __future__ import annotations

import re
from urllib.parse import quote

from pyspark.sql import Column
from pyspark.sql import functions as F

from period_etl.fixed import PERIOD_PATTERN

_PERIOD_RE = re.compile(PERIOD_PATTERN)
_INT_RE = re.compile(r"[+-]?\d+")


class PeriodError(ValueError):
    """An entry name or period string that cannot give a period."""


def last_segment(path: str) -> str:
    """P5: the last ``/`` segment of a path or URL (trailing slash ignored)."""
    segment = path.rstrip("/").rsplit("/", 1)[-1]
    if not segment:
        raise PeriodError(f"no file name in {path!r}")
    return segment


def period_from_name(name: str) -> str:
    """P6: first ``YYYY-MM`` match in an entry name; no match is an error."""
    hit = _PERIOD_RE.search(name)
    if hit is None:
        raise PeriodError(f"no period (YYYY-MM) in entry name {name!r}")
    return hit.group(0)


def parse_period(period: str) -> tuple[int, int]:
    """P7: ``"YYYY-MM"`` -> (year, month).

    The text is split on ``-`` and the first two parts must be integers.
    The month is not range-checked: ``2025-13`` parses and later matches no
    row, as a month filter on it would.
    """
    parts = period.split("-")
    if len(parts) < 2:
        raise PeriodError(f"period {period!r} has no '-'")
    year, month = parts[0], parts[1]
    if not (_INT_RE.fullmatch(year) and _INT_RE.fullmatch(month)):
        raise PeriodError(f"period {period!r} is not numeric YEAR-MONTH")
    return int(year), int(month)


def strip_scheme(path: str) -> str:
    """Drop ``scheme:`` / ``scheme://`` so a root matches Spark's file URIs.

    ``file:///a/b`` and ``file:/a/b`` both become ``/a/b``;
    ``s3a://bucket/a`` becomes ``bucket/a``.
    """
    m = re.match(r"^[A-Za-z][A-Za-z0-9+.\-]*:(//)?", path)
    rest = path[m.end():] if m else path
    if m and m.group(1) and rest.startswith("/"):
        rest = "/" + rest.lstrip("/")
    return rest.rstrip("/")


def entry_name_col(file_path: Column, root: str) -> Column:
    """Name of the landing entry holding a file: first segment under ``root``.

    Uses plain substring functions (no regex) so it stays cheap per row. A
    Spark part-file name such as ``part-00000-12ab.parquet`` is never looked
    at, which keeps ``0000-12`` from being read as a period.
    """
    key = _uri_key(root)
    pos = F.instr(file_path, key)
    rest = F.substring(file_path, pos + F.lit(len(key)), F.lit(1 << 30))
    name = F.substring_index(rest, "/", 1)
    return F.when(pos > 0, name)


_URI_SAFE = "/:@!$&'()*+,;=-._~"


def _uri_escape(text: str) -> str:
    """Escape text the way a file URI's path shows it: illegal ASCII
    characters become ``%XX``; letters beyond ASCII stay as they are."""
    return "".join(c if ord(c) > 127 else quote(c, safe=_URI_SAFE) for c in text)


def _uri_key(root: str) -> str:
    # Spark reports file paths as URIs: escape the root the same way.
    return _uri_escape(strip_scheme(root) + "/")


def landing_period_col(file_path: Column, root: str) -> Column:
    """P5 + P6 per row in one regex: first ``YYYY-MM`` in the entry's name.

    The pattern is anchored on the root, and ``[^/]*?`` keeps the search
    inside the first segment under it (the entry) and finds its leftmost
    period, so part-file names are never searched. One small regex keeps the
    generated code compact; entries are checked on the driver beforehand, so
    a miss (empty string) cannot occur for a listed entry.
    """
    pattern = re.escape(_uri_key(root)) + r"[^/]*?(" + PERIOD_PATTERN + ")"
    return F.regexp_extract(file_path, pattern, 1)


_PLAIN_NAME = re.compile(r"[A-Za-z0-9._=+,~-]*")


def shared_period_offset(names_and_periods) -> int | None:
    """Offset of the period in every entry name, if it is the same for all.

    Only names whose text before the period needs no URI escaping count, so
    the offset is the same in Spark's file URI. None when offsets differ.
    """
    offsets = set()
    for name, period in names_and_periods:
        at = name.index(period)          # the first match starts here
        if not _PLAIN_NAME.fullmatch(name[:at]):
            return None
        offsets.add(at)
    return offsets.pop() if len(offsets) == 1 else None


def names_are_plain(names) -> bool:
    """True when no entry name needs URI escaping in Spark's file paths."""
    return all(_PLAIN_NAME.fullmatch(n) for n in names)


def landing_period_decoded(file_path: Column, root: str) -> Column:
    """P5 + P6 per row for entry names that Spark's file URIs escape
    (spaces, ``%``, non-ASCII): decode the entry segment, then take its
    first ``YYYY-MM`` (an escape like ``%20`` must not lend its digits)."""
    return F.regexp_extract(F.url_decode(entry_name_col(file_path, root)), PERIOD_PATTERN, 0)


def landing_period_at(file_path: Column, root: str, offset: int) -> Column:
    """P5 + P6 per row without a regex, for entries whose period sits at
    the same ``offset`` in their names (checked on the driver): the seven
    characters at that place in the entry segment of the file's URI."""
    key = _uri_key(root)
    return F.substring(file_path, F.instr(file_path, key) + F.lit(len(key) + offset), F.lit(7))


def period_col(name: Column) -> Column:
    """P6 per row: first ``YYYY-MM`` in ``name``; raises when there is none."""
    hit = F.regexp_substr(name, F.lit(PERIOD_PATTERN))
    return F.coalesce(
        hit,
        F.raise_error(F.concat(F.lit("no period (YYYY-MM) in entry name: "),
                               F.coalesce(name, F.lit("<unknown>")))),
    )


def period_key_col(period: Column) -> Column:
    """P7 per row for a well-formed period: ``"2025-01"`` -> 202501 (int)."""
    return F.replace(period, F.lit("-"), F.lit("")).cast("int")


def month_key_col(ts: Column) -> Column:
    """P8 per row: ``year(ts) * 100 + month(ts)``; null in, null out."""
    return F.year(ts) * F.lit(100) + F.month(ts)


def month_text_col(ts: Column) -> Column:
    """``YYYY-MM`` of a timestamp, built from integers (no date formatter)."""
    return F.concat(F.lpad(F.year(ts).cast("string"), 4, "0"), F.lit("-"),
                    F.lpad(F.month(ts).cast("string"), 2, "0"))


def date_col(ts: Column) -> Column:
    """P9: calendar date of a timestamp; null in, null out."""
    return F.to_date(ts)
