"""Writers: Bronze append and compaction, Silver date-partition replace, full reloads. All are staged, then published."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.config import LakeConfig
from triplake.schemas import BRONZE_PARTITIONS, SILVER_PARTITIONS
from triplake.sinks.publish import Publisher


def new_key(name: str) -> str:
    return f"{name}-{uuid.uuid4().hex[:12]}"


def append_bronze(df: DataFrame, path: str, cfg: LakeConfig = LakeConfig(), key: str | None = None) -> bool:
    """Append rows under ``event_date=/event_type=`` directories; False if ``key`` has been appended before.

    Without a shuffle every task writes one file into every directory it touches (tasks x dates x types small files). A
    ``rebalance`` on the partition columns lets AQE size the write tasks: small directories are coalesced into one task, a hot
    date/type (a third of all rows, say) is split over several tasks, so file count and size stay bounded at any volume. The
    per-file row cap is a second bound. With ``cfg.rebalance_appends`` off nothing is shuffled, which suits batches of one or two
    dates; ``compact_bronze`` merges the files that many appends leave.
    """
    publisher = Publisher(df.sparkSession, path)
    once = key is not None
    key = key or new_key("append")
    stage = publisher.stage(key)
    if stage is None:
        return False
    w = df.hint("rebalance", *BRONZE_PARTITIONS) if cfg.rebalance_appends else df
    w = w.write.mode("overwrite").partitionBy(*BRONZE_PARTITIONS)
    if cfg.max_records_per_file:
        w = w.option("maxRecordsPerFile", cfg.max_records_per_file)
    w.parquet(f"{stage}/rows")
    publisher.publish(key, add={f"{stage}/rows": path}, once=once)
    return True


def compact_bronze(spark: SparkSession, path: str, before: str | None = None, target_bytes: int = 128 << 20) -> int:
    """Rewrite the partitions of closed dates (earlier than ``before``) that hold far more files than their bytes need.

    A partition of n bytes needs ceil(n / target_bytes) files; it is rewritten into at most that many if it has two or more and
    at least twice as many. Only those partitions are read, and dealt out by partition and by as many salts as each
    gets files, so a hot partition is no single task. A date is closed when no writer appends to it any more; a run that fails
    leaves the partitions as they were. Returns the number of partitions rewritten.
    """
    from triplake.sources.lake import BRONZE_SCHEMA

    publisher = Publisher(spark, path)
    publisher.recover()
    sizes: dict[str, list[int]] = {}
    for place, size in publisher.files.files(path):
        sizes.setdefault(place.rpartition("/")[0], []).append(size)
    wanted = {}
    for folder, own in sorted(sizes.items()):
        date = folder.split("/")[0].removeprefix(f"{BRONZE_PARTITIONS[0]}=")
        files = max(1, math.ceil(sum(own) / target_bytes))
        if len(own) >= max(2, 2 * files) and (before is None or date < before):
            wanted[folder] = files
    if not wanted:
        return 0
    key = new_key("compact")
    stage = publisher.stage(key)
    rows = spark.read.schema(BRONZE_SCHEMA).option("basePath", path).parquet(*[f"{path}/{folder}" for folder in wanted])
    files = F.lit(1)
    for folder, n in wanted.items():
        if n > 1:
            date, kind = (part.partition("=")[2] for part in folder.split("/"))
            files = F.when((F.col("event_date") == F.lit(date).cast("date")) & (F.col("event_type") == kind), F.lit(n)).otherwise(files)
    rows.repartition(sum(wanted.values()), *BRONZE_PARTITIONS, F.pmod(F.xxhash64("event_id", "ride_id"), files)).write.partitionBy(
        *BRONZE_PARTITIONS).parquet(f"{stage}/rows")
    publisher.publish(key, replace_parts={f"{stage}/rows": path}, touched=[])  # the rows are what they were
    return len(wanted)


def replace_date_partitions(tables: dict[str, DataFrame], home: str, state: dict | None = None) -> None:
    """Replace the ``event_date`` partitions that the frames produce, in all the tables (path -> frame) or in none.

    ``state`` becomes the home's state with them.

    Aggregated Silver data is small per date, so rows are grouped by date first to write one file per date partition.
    """
    spark = next(iter(tables.values())).sparkSession
    publisher = Publisher(spark, home)
    publisher.recover()
    key = new_key("replace")
    stage = publisher.stage(key)
    staged = {}
    for k, (path, df) in enumerate(tables.items()):
        staged[f"{stage}/{k}"] = path
        df.repartition(*SILVER_PARTITIONS).write.partitionBy(*SILVER_PARTITIONS).parquet(f"{stage}/{k}")
    for path in tables:
        publisher.files.fs.mkdirs(publisher.files.path(path))  # an empty result leaves an empty table
    publisher.publish(key, replace_parts=staged, state=state)


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Write a whole table in its one layout, empty or not.

    Tables are partitioned by their date so date-bounded reads prune; the ``rebalance`` lets AQE size the write tasks (a hot
    date is split, small ones merged) so files stay few and large. Readers declare the schema, so an empty table needs no file.
    """
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def reload_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Truncate and reload: the whole table is replaced once the new one is written."""
    publisher = Publisher(df.sparkSession, path.rpartition("/")[0])
    key = new_key("reload")
    stage = publisher.stage(key)
    write_table(df, f"{stage}/table", partition_by)
    publisher.publish(key, replace={f"{stage}/table": path})


def write_seed(df: DataFrame, path: str) -> None:
    """Master data as header CSV (the seed-file format)."""
    df.write.mode("overwrite").option("header", True).csv(path)
