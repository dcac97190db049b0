"""Schemas kept beside a stored dataset, so that reading it opens no footers but those of the rows that are read.

Each schema that is ever written is one small file under ``_schemas`` (a folder
that Spark's scans pass over), named by the digest of its content: a rerun
or a second writer of the same schema finds it there, and writers of different
ones don't touch each other's. It is recorded before the data, so a write that
dies leaves a column too many, never one too few. Data that was stored before
the first record gives its own schema then, from its footers.

A read takes the types that hold every recorded schema exactly. Columns stand
in the order in which they first came, and stay once they have been stored. Where
no schema is recorded, or the recorded ones have no common exact type, the
footers decide as they do without records. Files that others put into the
dataset are not known here; don't record the schemas of such a dataset.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from period_etl.sources.schemas import plain_type, widened

FOLDER = "_schemas"


def _folder(spark: SparkSession, path: str):
    """(the Hadoop file system, a function from a name to its path in the folder of schemas)."""
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = new(f"{path.rstrip('/')}/{FOLDER}")
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), lambda name="": new(root, name) if name else root


def record_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    """Keep a schema of the dataset at ``path``, if it isn't kept yet."""
    text = json.dumps(plain_type(schema).jsonValue(), sort_keys=True)
    fs, at = _folder(spark, path)
    target = at(hashlib.sha256(text.encode()).hexdigest() + ".json")
    if fs.exists(target):
        return
    draft = at(f".{uuid.uuid4().hex}")   # seen under its name only when it is whole
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(draft, target):
        fs.delete(draft, False)
        if not fs.exists(target):
            raise OSError(f"can't record a schema at {target}")


def records(spark: SparkSession, path: str) -> list[str]:
    """The names of the recorded schemas of the dataset at ``path``, oldest first."""
    fs, at = _folder(spark, path)
    if not fs.exists(at()):
        return []
    found = [(f.getModificationTime(), f.getPath().getName()) for f in fs.listStatus(at())]
    return [name for _, name in sorted(found) if name.endswith(".json")]


def recorded_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema that holds all recorded ones exactly; None without records or such a schema."""
    fs, at = _folder(spark, path)
    both: StructType | None = None
    for name in records(spark, path):
        stream = fs.open(at(name))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        one = StructType.fromJson(json.loads(text))
        both = one if both is None else widened(both, one)
        if both is None:
            return None
    return both
