"""S2: landing-set scan. Each entry under a landing root is one period file.

An *entry* is a file (``trips_2025-01.parquet``) or a directory of part files
(``trips_2025-01.parquet/part-…``) directly under the root. Its period is the
first ``YYYY-MM`` in the entry's own name, never in a part-file name.

All entries are read by **one** scan. Each row is tagged with its entry's
period from ``_metadata.file_path``: a per-file constant, so there is no
shuffle, no join and no per-entry branch in the plan; a month that holds a
third of all rows is simply more scan tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from period_etl.fixed import PERIOD
from period_etl.functions.periods import (
    PeriodError,
    entry_name_col,
    landing_period_at,
    landing_period_col,
    landing_period_decoded,
    last_segment,
    month_key_col,
    month_text_col,
    names_are_plain,
    period_col,
    period_key_col,
    period_from_name,
    shared_period_offset,
    strip_scheme,
)
from period_etl.sources.parquet import literal_path
from period_etl.sources.schemas import entry_types, footer_columns, merge_failed, resolve

_FILE_PATH = "__period_etl_file_path"
_ROW = "__period_etl_row"
#: Columns that say where a row stood in the landing set, in order.
INPUT_ORDER = (_FILE_PATH, _ROW)


@dataclass(frozen=True)
class LandingEntry:
    name: str
    period: str
    path: str


def _hidden(name: str) -> bool:
    return name.startswith(("_", "."))


def list_entry_names(spark: SparkSession, root: str) -> list[str]:
    """Names of the visible children of ``root``, sorted.

    One directory listing on the driver through the Hadoop file system the
    session already uses (the same call Spark makes to expand ``root/*``).
    """
    try:
        jvm = spark.sparkContext._jvm  # classic session
        hpath = jvm.org.apache.hadoop.fs.Path(root)
        fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(hpath)]
    except Exception as exc:  # pragma: no cover - e.g. a remote session
        if "does not exist" in str(exc) or "FileNotFound" in str(exc):
            raise FileNotFoundError(root) from exc
        # Fall back to Spark's own file index: first segment under the root.
        key = strip_scheme(root) + "/"
        names = set()
        for f in spark.read.format("binaryFile").load(root + "/*").inputFiles():
            rest = strip_scheme(f).split(key, 1)[-1]
            names.add(rest.split("/", 1)[0])
        names = list(names)
    return sorted(n for n in names if not _hidden(n))


def list_landing(spark: SparkSession, root: str,
                 entries: Sequence[str] | None = None,
                 on_duplicate: str = "error") -> list[LandingEntry]:
    """Entries of a landing set with their periods, one per period.

    ``entries`` are names under ``root`` (or URLs / paths, whose last
    segment is the name) in priority order (later wins);
    when omitted, all visible children of ``root`` are used in name order.
    Two entries with one period raise ``ValueError`` unless
    ``on_duplicate="last"``, which keeps the later entry only.
    """
    if on_duplicate not in ("error", "last"):
        raise ValueError("on_duplicate must be 'error' or 'last'")
    names = list(entries) if entries is not None else list_entry_names(spark, root)
    base = root.rstrip("/")
    chosen: dict[str, LandingEntry] = {}
    for given in names:
        # A URL or path names the entry by its last segment (P5), which is
        # where a downloaded file sits under the landing root.
        name = last_segment(given)
        period = period_from_name(name)
        if period in chosen and on_duplicate == "error":
            raise ValueError(
                f"period {period} named by two entries: {chosen[period].name!r} and {name!r}")
        chosen.pop(period, None)
        chosen[period] = LandingEntry(name, period, f"{base}/{name}")
    if not chosen:
        raise PeriodError(f"no landing entries under {root!r}")
    return list(chosen.values())


def qualify(spark: SparkSession, root: str) -> str:
    """The root as a fully qualified URI (relative paths made absolute)."""
    try:
        sc = spark.sparkContext
        hpath = sc._jvm.org.apache.hadoop.fs.Path(root)
        fs = hpath.getFileSystem(sc._jsc.hadoopConfiguration())
        return fs.makeQualified(hpath).toString()
    except Exception:  # pragma: no cover - remote session
        return root


def tag_period(df: DataFrame, root: str, file_path_col: str, checked: bool = True) -> DataFrame:
    """Replace a file-path column with the row's landing period (P5 + P6).

    ``checked=False`` is for files of entries already validated on the
    driver: one regex per row. ``checked=True`` (files of unknown entries,
    e.g. a file stream) raises on an entry name without a period.
    """
    fp = F.col(file_path_col)
    period = (period_col(F.url_decode(entry_name_col(fp, root))) if checked
              else landing_period_col(fp, root))
    return df.withColumn(PERIOD, period).drop(file_path_col)


def _read_entries(spark: SparkSession, entries: list[LandingEntry], options: dict, inexact: bool, ordered: bool = False) -> DataFrame:
    """All entries with the columns of all of them, a missing column as null, and each row's file path.

    The footers decide (one Spark job, no data read). Entries that agree, or
    only lack columns, are one scan. So are entries whose types can be widened
    without changing a value (see ``schemas``): a query over the footers finds the widened
    types and the scan reads with them. Other differences raise ``ValueError``
    with the names of two entries; ``inexact`` lets mixed numbers take Spark's
    common type instead, which may round, with one scan for each mixture.
    """
    def scan(some, schema=None):
        reader = spark.read.options(**options)
        reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", options.get("mergeSchema", "true"))
        # Take only file_path out of _metadata right at the scan.
        return reader.parquet(*[literal_path(e.path) for e in some]).select("*", *places)

    places = [F.col("_metadata.file_path").alias(_FILE_PATH), *[F.col("_metadata.row_index").alias(_ROW)] * ordered]

    try:
        return scan(entries)
    except Exception as exc:
        if not merge_failed(exc):
            raise
    columns = footer_columns(spark, [qualify(spark, e.path) for e in entries])
    schema, loose = resolve(columns, [e.name for e in entries], inexact)
    if not loose:
        return scan(entries, schema)
    own = entry_types(columns, list(loose))
    groups: dict[str, tuple[StructType, list[LandingEntry]]] = {}
    for i, entry in enumerate(entries):
        kinds = own.get(i, {})
        mine = StructType([StructField(f.name, kinds.get(f.name, f.dataType)) for f in schema])
        groups.setdefault(mine.json(), (mine, []))[1].append(entry)
    out = None
    for mine, some in groups.values():
        df = scan(some, mine).select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema], _FILE_PATH, *[_ROW] * ordered)
        out = df if out is None else out.unionByName(df)
    return out


def _scan(spark: SparkSession, root: str, entries: Sequence[str] | None,
          on_duplicate: str, options: dict, inexact: bool,
          ordered: bool = False) -> tuple[DataFrame, Column, bool]:
    """One scan of the chosen entries plus the per-row period expression.

    When every entry name has its period at the same place (the usual
    ``name_YYYY-MM.parquet`` set) the period is a fixed-position substring
    of the file path; otherwise one anchored regex finds it, on the decoded
    entry name when some name needs URI escaping.
    """
    root = qualify(spark, root)
    chosen = list_landing(spark, root, entries, on_duplicate)
    df = _read_entries(spark, chosen, options, inexact, ordered)
    fp = F.col(_FILE_PATH)
    offset = shared_period_offset((e.name, e.period) for e in chosen)
    if offset is not None:
        return df, landing_period_at(fp, root, offset), True
    if names_are_plain(e.name for e in chosen):
        return df, landing_period_col(fp, root), False
    return df, landing_period_decoded(fp, root), False


def read_landing(spark: SparkSession, root: str,
                 entries: Sequence[str] | None = None,
                 on_duplicate: str = "error", inexact: bool = False,
                 **options: str) -> DataFrame:
    """S2: every landing entry in one scan, plus a ``period`` string column."""
    df, period, _ = _scan(spark, root, entries, on_duplicate, options, inexact)
    return df.withColumn(PERIOD, period).drop(_FILE_PATH)


def read_landing_clean(spark: SparkSession, root: str, ts_col: str,
                       entries: Sequence[str] | None = None,
                       on_duplicate: str = "error", inexact: bool = False,
                       ordered: bool = False, **options: str) -> DataFrame:
    """S2 + L2 fused: the landing rows that lie in their own entry's month.

    Same rows as ``clean_tagged(read_landing(...))``. On the regex path the
    regex runs once, inside the month test, and a kept row's ``period`` is
    its own ``YYYY-MM`` (equal to its entry's by the test); on the
    fixed-position path the substring is cheap enough to take twice. With
    ``ordered`` the rows keep the columns of INPUT_ORDER.
    """
    df, period, fixed_position = _scan(spark, root, entries, on_duplicate, options, inexact, ordered)
    ts = F.col(ts_col)
    own = month_key_col(ts) == period_key_col(period)
    out = period if fixed_position else month_text_col(ts)
    kept = df.filter(own).withColumn(PERIOD, out)
    return kept if ordered else kept.drop(_FILE_PATH)

