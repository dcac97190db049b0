"""Helpers that the operators share: scratch tables, ordered tables, connected components."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from period_etl.session import scratch_dir

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_shipped: set[str] = set()
_ROW_BITS = 33  # monotonically_increasing_id: the partition above, the row below


def ship(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once for each application, and bound their batches.

    Batches of whole texts need not hold 10,000 rows: where the session has
    Spark's default, it is set to 1,000, which bounds the memory beside the heap.
    """
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, "1000")
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[2]
        sc.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp(prefix='period_etl-')}/period_etl", "zip", root, "period_etl"))
        _shipped.add(sc.applicationId)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write the frame to the shared scratch folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def parts(spark: SparkSession, wanted: int) -> int:
    """A partition count: ``wanted``, and the session's shuffle partitions at least if that is a number."""
    setting = spark.conf.get("spark.sql.shuffle.partitions", "200")
    return max(1, wanted, int(setting) if setting.isdigit() else 1)


def ordered(df: DataFrame, *keys, partitions: int | None = None) -> DataFrame:
    """The rows in ``keys`` order over range partitions, with ``_part`` and ``_row``
    (0, 1, ... in each partition). Store the result before using it twice."""
    n = partitions or parts(df.sparkSession, 1)
    out = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    return out.withColumn("_id", F.monotonically_increasing_id()).withColumns({
        "_part": F.shiftright("_id", _ROW_BITS).cast("int"),
        "_row": F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
    }).drop("_id")


def components(links: DataFrame, a: str = "a", b: str = "b", label: str = "components") -> DataFrame:
    """(id, component): for each id in a link, the smallest id reachable.

    Labels spread along links and then jump to their label's label, so the
    rounds grow with the logarithm of a chain's length. Each round is a
    stored table; joins are plain shuffles of stored tables, so a hub with
    many links is split by the adaptive skew join.
    """
    both = stored(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
                  .union(links.select(F.col(b).alias("u"), F.col(a).alias("v")).where("u != v")).distinct(), label)
    labels = stored(both.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("v"))
                    .select("id", F.least("id", "v").alias("component")), label)
    while True:
        near = both.join(labels.withColumnRenamed("id", "v"), "v").groupBy(F.col("u").alias("id")).agg(
            F.min("component").alias("near"))
        step = stored(labels.join(near, "id").select(
            "id", F.col("component").alias("old"), F.least("component", "near").alias("component")), label)
        changed = step.where("old != component").limit(1).count()
        if not changed:
            return step.select("id", "component")
        up = step.select(F.col("id").alias("component"), F.col("component").alias("up"))
        labels = stored(step.select("id", "component").join(up, "component", "left").select(
            "id", F.least("component", F.coalesce("up", "component")).alias("component")), label)
