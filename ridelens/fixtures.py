"""Lakes built from the driver's tables through the lens.

Landing is the expensive, shared step (like a real lake, Bronze is written
once and queried many times), so each stage is memoised per Spark
application and input folder. Queries that modify a layer get a fresh lake.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from triplake.plans import jobs
from triplake.schemas import ENVELOPE_SCHEMA
from triplake.session import configure, scratch_path
from ridelens import lens

_DONE: dict[tuple, jobs.LakePaths] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def envelopes(spark: SparkSession, sf_dir: str, least_tasks: int = 1) -> DataFrame:
    configure(spark)
    return lens.envelopes(table(spark, sf_dir, "events"), table(spark, sf_dir, "region"), least_tasks)


def seeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    drivers = lens.seed_drivers(table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation"))
    riders = lens.seed_riders(table(spark, sf_dir, "customer"))
    return drivers, riders


def _key(spark, sf_dir, stage):
    return (spark.conf.get("spark.app.id", None), sf_dir.rstrip("/"), stage)


def bronze_lake(spark: SparkSession, sf_dir: str) -> jobs.LakePaths:
    """Bronze landed from the lens, plus the seed files."""
    k = _key(spark, sf_dir, "bronze")
    if k not in _DONE:
        paths = jobs.LakePaths(scratch_path(spark, "lake"))
        jobs.land_bronze(envelopes(spark, sf_dir), paths, lens.LENS_CONFIG)
        jobs.write_seeds(*seeds(spark, sf_dir), paths)
        _DONE[k] = paths
    return _DONE[k]


def topic(spark: SparkSession, sf_dir: str) -> str:
    """The lens messages as parquet files: the stand-in for a topic.

    One file per core per micro-batch, two batches' worth or more, like a
    topic with that many partitions. The rides are dealt out before they are
    expanded, so no message is shuffled.
    """
    k = _key(spark, sf_dir, "topic")
    if k not in _DONE:
        path = scratch_path(spark, "topic")
        envelopes(spark, sf_dir, 2 * parallelism(spark)).write.option("compression", "zstd").parquet(path)
        _DONE[k] = path
    return _DONE[k]


parallelism = lens.parallelism


def files_per_batch(spark: SparkSession, topic_path: str) -> int:
    """Files a micro-batch takes so that two drain a topic; one per core at least."""
    files = spark.read.schema(ENVELOPE_SCHEMA).parquet(topic_path).inputFiles()
    return max(parallelism(spark), -(-len(files) // 2))


def fresh_lake(spark: SparkSession, sf_dir: str, name: str) -> jobs.LakePaths:
    """A new lake root sharing the landed Bronze and seeds (read-only)."""
    base = bronze_lake(spark, sf_dir)
    return jobs.LakePaths(scratch_path(spark, name), bronze_root=base.bronze)


def silver_lake(spark: SparkSession, sf_dir: str) -> jobs.LakePaths:
    """Bronze + Silver for every date."""
    k = _key(spark, sf_dir, "silver")
    if k not in _DONE:
        paths = bronze_lake(spark, sf_dir)
        jobs.run_silver(spark, paths, None)
        _DONE[k] = paths
    return _DONE[k]


def gold_lake(spark: SparkSession, sf_dir: str) -> jobs.LakePaths:
    """Bronze + Silver + RAW + Gold."""
    k = _key(spark, sf_dir, "gold")
    if k not in _DONE:
        paths = silver_lake(spark, sf_dir)
        jobs.load_raw(spark, paths)
        jobs.build_gold(spark, paths)
        _DONE[k] = paths
    return _DONE[k]


def copy_seeds(spark: SparkSession, src: jobs.LakePaths, dst: jobs.LakePaths, complete: bool = False) -> None:
    """Give a fresh lake its own seed files (read from the shared ones); ``complete`` adds the drivers that only Bronze names."""
    from triplake.sinks.lake import write_seed
    from triplake.sources import lake as rd
    drivers = rd.read_seed_drivers(spark, src.seed_drivers)
    if complete:
        drivers = drivers.unionByName(lens.unlisted_drivers(rd.read_bronze(spark, src.bronze), drivers))
    write_seed(drivers, dst.seed_drivers)
    write_seed(rd.read_seed_riders(spark, src.seed_riders), dst.seed_riders)
