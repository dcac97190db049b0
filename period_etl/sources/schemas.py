"""One schema for Parquet entries whose footers differ, found by one query over them.

Tasks list the files of their entries and read the footers alone; what leaves
a task is each distinct (column, type) with the first entry that has it, and a
partial aggregate folds these on. The driver sees one row for each column and
type, however many entries there are.

Types are joined only where every value stays what it is: integers to wider
ones, float to double, integers up to 32 bits to double, integers and decimals
to a decimal that holds both, and structs, arrays and maps by their parts.
``bigint`` and ``double`` are not joined: doubles above 2**53 skip integers.
Spark's Parquet reader does all these widenings while it reads, so entries that
differ this way are still one scan.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NumericType,
    ShortType,
    StructField,
    StructType,
)

#: Integers, narrow to wide, with the digits that they may have.
_INTEGERS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 20}
#: Error classes with which Spark says that footers don't agree.
MERGE_ERRORS = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")


def merge_failed(error: Exception) -> bool:
    """Whether Spark refused to merge footers (and nothing else went wrong): the error class of it or of a cause."""
    known = getattr(error, "getCondition", lambda: None)() or ""
    cause = getattr(error, "java_exception", None)
    while cause is not None and not known.startswith(MERGE_ERRORS):
        if cause.getClass().getName() == "org.apache.spark.SparkException":
            known = cause.getCondition() or ""
        cause = cause.getCause()
    return known.startswith(MERGE_ERRORS)


def widened(a: DataType, b: DataType) -> DataType | None:
    """The type that holds every value of both types exactly, or None."""
    if a == b:
        return a
    if isinstance(a, StructType) and isinstance(b, StructType):
        fields = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            kind = widened(fields.get(f.name, f.dataType), f.dataType)
            if kind is None:
                return None
            fields[f.name] = kind
        return StructType([StructField(name, kind) for name, kind in fields.items()])
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        element = widened(a.elementType, b.elementType)
        return element and ArrayType(element)
    if isinstance(a, MapType) and isinstance(b, MapType):
        key, value = widened(a.keyType, b.keyType), widened(a.valueType, b.valueType)
        return MapType(key, value) if key and value else None
    if a in _INTEGERS and b in _INTEGERS:
        return max(a, b, key=_INTEGERS.__getitem__)
    kinds = {type(a), type(b)}
    if kinds <= {ByteType, ShortType, IntegerType, FloatType, DoubleType}:
        return DoubleType()
    if DecimalType in kinds and all(isinstance(t, DecimalType) or t in _INTEGERS for t in (a, b)):
        p, q = (t if isinstance(t, DecimalType) else DecimalType(_INTEGERS[t], 0) for t in (a, b))
        scale = max(p.scale, q.scale)
        precision = scale + max(p.precision - p.scale, q.precision - q.scale)
        return DecimalType(precision, scale) if precision <= 38 else None
    return None


def plain_type(kind: DataType) -> DataType:
    """The type with all parts nullable, so that only real differences count."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, plain_type(f.dataType)) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(plain_type(kind.elementType))
    if isinstance(kind, MapType):
        return MapType(plain_type(kind.keyType), plain_type(kind.valueType))
    return kind


def footer_columns(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(name, type, entry, position) of the files under each path (a file or a folder): the distinct columns of each
    entry, types as Spark's JSON, entries by their place in ``paths``. Footers are read in tasks, data isn't."""
    def run(batches):
        import json

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs
        from pyspark.sql.pandas.types import from_arrow_type

        unsigned = {pa.uint8(): "short", pa.uint16(): "integer", pa.uint32(): "long", pa.uint64(): "decimal(20,0)"}
        names = ["name", "type", "entry", "position"]

        def columns(file):
            made = file.metadata.metadata or {}
            if b"org.apache.spark.sql.parquet.row.metadata" in made:
                for f in json.loads(made[b"org.apache.spark.sql.parquet.row.metadata"])["fields"]:
                    yield f["name"], f["type"]
                return
            old = {c.path: c.physical_type for c in (file.schema.column(i) for i in range(len(file.schema)))}
            for f in file.schema_arrow:
                if old.get(f.name) == "INT96":
                    yield f.name, "timestamp"
                elif f.type in unsigned:
                    yield f.name, unsigned[f.type]
                else:
                    yield f.name, from_arrow_type(f.type, prefer_timestamp_ntz=True).jsonValue()

        for batch in batches:
            for entry, uri in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                scheme, _, rest = uri.partition(":")
                uri = f"file:///{rest.lstrip('/')}" if scheme == "file" else "s3:" + rest if scheme in ("s3a", "s3n") else uri
                from urllib.parse import unquote
                system, path = (fs.LocalFileSystem(), "/" + unquote(uri[8:])) if scheme == "file" else fs.FileSystem.from_uri(uri)
                info = system.get_file_info(path)
                files = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(path, recursive=True))
                seen = {}
                for f in sorted((f for f in files if f.type == fs.FileType.File), key=lambda f: f.path):
                    inside = f.path[len(path):].strip("/").split("/")
                    if any(p.startswith(("_", ".")) for p in inside) or (len(inside) > 1 and f.size == 0):
                        continue
                    with system.open_input_file(f.path) as source:
                        for name, kind in columns(pq.ParquetFile(source)):
                            seen.setdefault((name, json.dumps(kind)), len(seen))
                    for part in inside[:-1]:   # folders key=value inside an entry are columns too
                        if "=" in part:
                            seen.setdefault((part.split("=")[0], '"string"'), len(seen))
                yield pa.record_batch([[n for n, _ in seen], [k for _, k in seen], pa.array([entry] * len(seen), pa.int32()), pa.array(seen.values(), pa.int32())],
                                      schema=pa.schema([("name", pa.string()), ("type", pa.string()), ("entry", pa.int32()), ("position", pa.int32())]))

    setting = spark.conf.get("spark.sql.shuffle.partitions", "200")
    tasks = max(1, min(len(paths), int(setting) if setting.isdigit() else 200))
    listed = spark.createDataFrame(list(enumerate(paths)), "entry int, uri string").repartition(tasks)
    return listed.mapInArrow(run, "name string, type string, entry int, position int")


def resolve(columns: DataFrame, labels: Sequence[str], inexact: bool = False) -> tuple[StructType, dict[str, DataType]]:
    """(the schema that holds all columns of ``footer_columns``, the columns that it holds inexactly).

    Columns stand in the order of their first entry. Types without a common
    exact one raise ``ValueError`` with the names (``labels``) of two entries;
    with ``inexact`` numbers then take the type that Spark gives to their
    mixture, and are named in the second result.
    """
    kinds = columns.groupBy("name", "type").agg(F.min(F.struct("entry", "position")).alias("at")).collect()
    schema: dict[str, tuple[str, DataType]] = {}
    loose: dict[str, DataType] = {}
    for row in sorted(kinds, key=lambda r: tuple(r["at"])):
        label, kind = labels[row["at"]["entry"]], plain_type(StructType.fromJson(
            {"type": "struct", "fields": [{"name": "v", "type": json.loads(row["type"]), "nullable": True, "metadata": {}}]})["v"].dataType)
        first, known = schema.get(row["name"], (label, kind))
        both = widened(known, kind)
        if both is None and inexact and isinstance(known, NumericType) and isinstance(kind, NumericType):
            spark = columns.sparkSession
            both = spark.range(0).select(F.coalesce(F.lit(None).cast(known), F.lit(None).cast(kind)).alias("v")).schema["v"].dataType
            loose[row["name"]] = both
        if both is None:
            raise ValueError(f"column {row['name']!r} is {known.simpleString()} in {first!r} and {kind.simpleString()} in {label!r}")
        if row["name"] in loose:
            loose[row["name"]] = both
        schema[row["name"]] = first, both
    return StructType([StructField(name, kind) for name, (_, kind) in schema.items()]), loose


def entry_types(columns: DataFrame, names: Sequence[str]) -> dict[int, dict[str, DataType]]:
    """The type of each named column in each entry that has it."""
    out: dict[int, dict[str, DataType]] = {}
    for row in columns.where(F.col("name").isin(list(names))).collect():
        kind = StructType.fromJson({"type": "struct", "fields": [{"name": "v", "type": json.loads(row["type"]), "nullable": True, "metadata": {}}]})["v"].dataType
        have = out.setdefault(row["entry"], {})
        if have.setdefault(row["name"], kind) != kind:
            raise ValueError(f"column {row['name']!r} has two types in one entry")
    return out
