"""Session settings and the shared folder jobs write to."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. The time zone fixes `to_date` / `hour`
# semantics (events carry UTC offsets); AQE coalesces small shuffles, splits
# skewed join partitions and turns joins whose measured side is small into
# broadcast joins at run time.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Sizing for a large cluster (hundreds of executors, tens of TB per run).
# Shuffles start wide and AQE coalesces them to ~128 MB partitions (or
# splits skewed ones), so no stage has to guess a width; scans read 256 MB
# splits. A task's input then stays far below executor memory, and spills
# stay rare, whatever the day's volume.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(app_name: str = "triplake", master: str | None = None,
                  shuffle_partitions: int | None = None, profile: str | None = None,
                  conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session configured for the lake jobs.

    ``profile="cluster"`` adds ``CLUSTER_CONF``; explicit arguments and
    ``conf`` win.
    """
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    if profile == "cluster":
        for k, v in CLUSTER_CONF.items():
            builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the job settings to an existing session (idempotent)."""
    for k, v in JOB_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as named by ``spark.checkpoint.dir``.

    Only when the session names none (a local test run) do we create one
    under the machine's temp folder and register it as the checkpoint dir.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:  # classic sessions may have had a directory set at run time
            d = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - no SparkContext on a remote session
            d = None
    if not d:
        master = spark.conf.get("spark.master", "") or ""
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="triplake-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(d)
        except Exception:  # noqa: BLE001
            pass
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared dir for one run's tables."""
    app = spark.conf.get("spark.app.id", None) or "app"
    return f"{shared_dir(spark)}/triplake/{app}/{name}-{uuid.uuid4().hex[:12]}"
