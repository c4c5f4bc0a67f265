"""Written tables in the cluster's shared folder: they cut lineage and survive a lost executor."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable

import triplake
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.session import scratch_path

# A table may be broadcast up to this many bytes (sum of its cells' text lengths); beyond it joins shuffle.
BROADCAST_BYTES = 8 << 20


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back with the same schema."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", "zstd")
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def renamed(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns called u0, u1, ... (no operator's own names are), and those names by the old ones."""
    names = {c: f"u{k}" for k, c in enumerate(df.columns)}
    return df.toDF(*[f"u{k}" for k in range(len(df.columns))]), names


def small_enough(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a written table's rows, as text, take at most ``limit`` bytes (one aggregate, one row back)."""
    width = F.lit(0)
    for c in df.columns:
        width = width + F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 16
    return (df.agg(F.sum(width.cast("long"))).first()[0] or 0) <= limit


def maybe_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its measured size allows that, else unchanged (shuffled join)."""
    return F.broadcast(df) if small_enough(df, limit) else df


def default_width(spark: SparkSession) -> int:
    """Number of shuffle partitions the session asks for."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application (``addPyFile`` of a zip)."""
    sc = spark.sparkContext
    if getattr(sc, "_triplake_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(triplake.__file__)))
    stage = os.path.realpath(tempfile.mkdtemp(prefix="triplake-pkg-"))
    shutil.copytree(os.path.join(root, "triplake"), os.path.join(stage, "src", "triplake"),
                    ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(os.path.join(stage, "triplake_code"), "zip", os.path.join(stage, "src")))
    sc._triplake_shipped = True


def map_arrow(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with the package available on the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)
