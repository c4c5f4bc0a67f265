"""Readers for landed layers and seed files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    BooleanType, DateType, StringType, StructField, StructType, TimestampType,
)

from triplake.schemas import EVENT_SCHEMA, SEED_DRIVERS_SCHEMA, SEED_RIDERS_SCHEMA

# Bronze as stored: event fields except the partition column event_type, the
# added columns, then the two partition columns (discovery appends them).
BRONZE_SCHEMA = StructType(
    [f for f in EVENT_SCHEMA.fields if f.name != "event_type"]
    + [
        StructField("kafka_time", TimestampType()),
        StructField("event_timestamp", TimestampType()),
        StructField("is_valid_city", BooleanType()),
        StructField("ride_duration_min", EVENT_SCHEMA["duration_min"].dataType),
        StructField("ingest_time", TimestampType()),
        StructField("source_topic", StringType()),
        StructField("event_date", DateType()),
        StructField("event_type", StringType()),
    ]
)

HINTS = {
    "bronze": "the `stream` job lands it",
    "silver": "the `silver` job writes it",
    "raw": "the `load-raw` job writes it",
    "gold": "the `gold` job writes it",
    "seed": "master data is read from header CSV files there",
}


class MissingLayerError(RuntimeError):
    """A layer that a job reads has not been written yet."""

    def __init__(self, layer: str, path: str, cause: Exception | None = None):
        self.layer, self.path = layer, path
        super().__init__(f"no {layer} layer at {path} ({HINTS.get(layer, 'unknown layer')}): {cause}")


def read_layer(spark: SparkSession, path: str, layer: str,
               schema: StructType | None = None) -> DataFrame:
    """Read a parquet layer with partition discovery; typed error if absent.

    A declared schema skips footer inference, which matters on a lake with
    many files. Partition columns named in the schema are taken from the
    directory names.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as exc:
        raise MissingLayerError(layer, path, exc) from exc


def read_bronze(spark: SparkSession, path: str, dates: list[str] | None = None) -> DataFrame:
    """Bronze, optionally only some ``event_date`` partitions.

    With ``dates`` only those date folders are listed (``basePath`` keeps
    the partition columns), instead of listing the whole history and then
    pruning; a date without a folder simply contributes no rows.
    """
    if not dates:
        return read_layer(spark, path, "bronze", BRONZE_SCHEMA)
    import datetime as dt

    dates = [dt.date.fromisoformat(str(d)).isoformat() for d in dates]  # ValueError on a bad date
    reader = spark.read.schema(BRONZE_SCHEMA).option("basePath", path)
    try:
        return reader.parquet(*[f"{path}/event_date={d}" for d in dates])
    except AnalysisException:
        # some date folder is absent: fall back to the pruned full read
        # (raises MissingLayerError if Bronze itself is missing)
        from pyspark.sql import functions as F

        full = read_layer(spark, path, "bronze", BRONZE_SCHEMA)
        return full.filter(F.col("event_date").isin(*[F.lit(d).cast("date") for d in dates]))


def read_seed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Header CSV with declared column types (no inference pass).

    The header is checked against the schema (``enforceSchema`` off), so a
    file whose columns are reordered or renamed fails instead of being
    mapped by position into the wrong fields.
    """
    try:
        return (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
                .option("mode", "FAILFAST").csv(path))
    except AnalysisException as exc:
        raise MissingLayerError("seed", path, exc) from exc


def read_seed_drivers(spark: SparkSession, path: str) -> DataFrame:
    return read_seed(spark, path, SEED_DRIVERS_SCHEMA)


def read_seed_riders(spark: SparkSession, path: str) -> DataFrame:
    return read_seed(spark, path, SEED_RIDERS_SCHEMA)
