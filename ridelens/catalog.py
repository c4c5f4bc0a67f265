"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's tables (through the lens) or lake layers
Spark derived from them. Timestamps are returned as ``timestamp_ntz`` (UTC
wall time) and nested points flattened, so results compare cleanly with
other engines.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelens import fixtures as fx
from ridelens import lens
from ridelens.lens import LENS_CONFIG, LENS_STRICT_CONFIG
from triplake.operators import bi as BI
from triplake.operators import bronze as B
from triplake.operators import gold as G
from triplake.operators import quality as Q
from triplake.operators import raw as R
from triplake.operators import silver as S
from triplake.operators import verify as V
from triplake.plans import jobs
from triplake.plans import namespaces as ns
from triplake.plans import pipeline as P
from triplake.schemas import ENVELOPE_SCHEMA
from triplake.session import configure, scratch_path
from triplake.sources import bus
from triplake.sources import lake as src
from triplake.streaming import bronze_stream

ONE_DAY = "2024-01-05"
RERUN_DAY = "2024-01-10"
EMPTY_DAY = "2023-12-31"
PIPELINE_DAY = "2024-01-15"
STREAM_SPLIT_AT = "2024-01-16 00:00:00"


def _ntz(c: str):
    return F.col(c).cast("timestamp_ntz").alias(c)


def event_columns() -> list:
    """The 19 event fields with the two points flattened (built lazily:
    Column objects need an active session)."""
    return [
    "event_id", "event_type", "event_time", "ride_id", "city", "rider_id", "driver_id",
    "vehicle_type",
    F.col("pickup.lat").alias("pickup_lat"), F.col("pickup.lon").alias("pickup_lon"),
    F.col("dropoff.lat").alias("dropoff_lat"), F.col("dropoff.lon").alias("dropoff_lon"),
    "duration_min", "distance_km", "fare_amount", "amount", "currency", "payment_method",
    "status", "cancelled_by", "reason",
    ]


def _bronze_rows(df: DataFrame) -> DataFrame:
    """Bronze minus the wall-clock ``ingest_time``, flattened, ntz times."""
    return df.select(
        *event_columns(), _ntz("kafka_time"), _ntz("event_timestamp"), "is_valid_city",
        "ride_duration_min", "source_topic", "event_date",
    )


def _bronze(spark, sf) -> DataFrame:
    return src.read_bronze(spark, fx.bronze_lake(spark, sf).bronze)


def _overlay_bronze(spark, sf) -> DataFrame:
    return lens.overlay(_bronze(spark, sf))


def _transformed(spark, sf) -> DataFrame:
    return B.transform(fx.envelopes(spark, sf), LENS_CONFIG)


# -- Bronze -------------------------------------------------------------------- #
def bronze_parse(spark, sf):
    parsed = B.parse(fx.envelopes(spark, sf))
    return parsed.select(*event_columns(), _ntz("kafka_time"))


def bronze_clean(spark, sf):
    return _transformed(spark, sf).select(
        "event_id", "event_type", "ride_id", "event_time", _ntz("event_timestamp"), "event_date")


def bronze_city_tag(spark, sf):
    return _transformed(spark, sf).select("event_id", "event_type", "city", "is_valid_city")


def bronze_duration(spark, sf):
    return _transformed(spark, sf).select("event_id", "event_type", "duration_min", "ride_duration_min")


def bronze_metadata(spark, sf):
    return _transformed(spark, sf).groupBy("source_topic").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("ingest_time").alias("rows_with_ingest_time"),
    )


def bronze_roundtrip(spark, sf):
    return _bronze_rows(_bronze(spark, sf))


def bronze_event_counts(spark, sf):
    return B.event_counts(_bronze(spark, sf))


def bronze_slice_by_type(spark, sf):
    b = _bronze(spark, sf)
    parts = [
        B.slice_type(b, t).agg(
            F.lit(t).alias("event_type"),
            F.count(F.lit(1)).alias("rows"),
            F.count_distinct("ride_id").alias("rides"),
        )
        for t in ("ride_ended", "ride_requested", "payment_completed")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def bronze_stream_land(spark, sf):
    """Topic files -> stream (two micro-batches) -> fresh Bronze, read back.

    Each micro-batch takes half the files, one per core at least.
    """
    root = scratch_path(spark, "stream")
    topic = fx.topic(spark, sf)
    bronze_stream.run_available(
        bus.file_stream(spark, topic, max_files_per_trigger=fx.files_per_batch(spark, topic)),
        f"{root}/bronze", f"{root}/_checkpoint", LENS_CONFIG)
    return _bronze_rows(src.read_bronze(spark, f"{root}/bronze"))


def bronze_stream_resume(spark, sf):
    """Two bounded runs on one checkpoint with files added in between."""
    root = scratch_path(spark, "resume")
    topic = f"{root}/topic"
    env = spark.read.schema(ENVELOPE_SCHEMA).parquet(fx.topic(spark, sf))
    split = F.col("timestamp") < F.lit(STREAM_SPLIT_AT).cast("timestamp")
    env.filter(split).write.mode("append").parquet(topic)
    stream = lambda: bus.file_stream(spark, topic, max_files_per_trigger=fx.files_per_batch(spark, topic))
    bronze_stream.run_available(stream(), f"{root}/bronze", f"{root}/_checkpoint", LENS_CONFIG)
    env.filter(~split).write.mode("append").parquet(topic)
    bronze_stream.run_available(stream(), f"{root}/bronze", f"{root}/_checkpoint", LENS_CONFIG)
    return src.read_bronze(spark, f"{root}/bronze").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("event_id").alias("distinct_events"),
    )


def bronze_batch_summary(spark, sf):
    """Cached micro-batches: what the batches' summaries counted beside what landed, per event type."""
    root = scratch_path(spark, "cached")
    batches: list = []
    topic = fx.topic(spark, sf)
    bronze_stream.run_available(
        bus.file_stream(spark, topic, max_files_per_trigger=fx.files_per_batch(spark, topic)),
        f"{root}/bronze", f"{root}/_checkpoint", LENS_CONFIG, summaries=batches, cache_batches=True)
    counted = [(t, n) for _, _, counts in batches for t, n in counts]  # at most six types a batch
    summarised = spark.createDataFrame(counted, "event_type string, n long").groupBy("event_type").agg(F.sum("n").alias("summarised"))
    landed = B.event_counts(src.read_bronze(spark, f"{root}/bronze")).withColumnRenamed("count", "landed")
    return landed.join(summarised, "event_type", "full")


# -- Silver -------------------------------------------------------------------- #
def silver_ride_counts(spark, sf):
    return S.ride_counts(_bronze(spark, sf))


def silver_revenue(spark, sf):
    return S.revenue(_bronze(spark, sf))


def silver_daily_city_metrics(spark, sf):
    return S.daily_city_metrics(_bronze(spark, sf), sort=True)


def silver_hourly_requests(spark, sf):
    return S.hourly_requests(_bronze(spark, sf))


def silver_hourly_demand(spark, sf):
    return S.hourly_demand(_bronze(spark, sf), sort=True)


def silver_peak_hour(spark, sf):
    return S.peak_hours(_bronze(spark, sf))


def silver_daily_one_day(spark, sf):
    return S.daily_city_metrics(S.for_date(_bronze(spark, sf), ONE_DAY), sort=True)


def silver_overwrite_one_day(spark, sf):
    """Backfill Silver, then re-run one date on changed Bronze: only it changes."""
    paths = fx.fresh_lake(spark, sf, "overwrite")
    jobs.run_silver(spark, paths, None)
    jobs.run_silver(spark, paths, RERUN_DAY, bronze=_overlay_bronze(spark, sf))
    return jobs.read_silver_daily(spark, paths)


def silver_empty_day_noop(spark, sf):
    """A date without Bronze rows writes nothing; earlier Silver stays."""
    paths = fx.fresh_lake(spark, sf, "noop")
    jobs.run_silver(spark, paths, None)
    if jobs.run_silver(spark, paths, EMPTY_DAY):
        raise AssertionError("empty date must not write")
    return jobs.read_silver_daily(spark, paths)


# -- RAW ----------------------------------------------------------------------- #
def raw_rides(spark, sf):
    return R.build_rides(_bronze(spark, sf))


def raw_upper_columns(spark, sf):
    return jobs.raw_table(spark, fx.gold_lake(spark, sf), "rides")


def raw_rides_by_name(spark, sf):
    """RAW rides as a catalog table, in namespaces of the lake's own."""
    paths = dataclasses.replace(fx.gold_lake(spark, sf), namespace="lens_")
    ns.ensure_namespaces(spark, paths)
    ns.register_raw(spark, paths, dict(zip(ns.RAW_TABLES, jobs.raw_schemas(spark).values())))
    return spark.table("lens_raw.rides")


def raw_daily_load(spark, sf):
    return jobs.raw_table(spark, fx.gold_lake(spark, sf), "daily")


def raw_hourly_load(spark, sf):
    return jobs.raw_table(spark, fx.gold_lake(spark, sf), "hourly")


# -- Gold ---------------------------------------------------------------------- #
def seed_load(spark, sf):
    return src.read_seed_drivers(spark, fx.bronze_lake(spark, sf).seed_drivers)


def seed_load_riders(spark, sf):
    return src.read_seed_riders(spark, fx.bronze_lake(spark, sf).seed_riders)


def _raw(spark, sf, t):
    return jobs.read_raw(spark, fx.gold_lake(spark, sf), t)


def stg_rides(spark, sf):
    return G.stg_rides(_raw(spark, sf, "rides"))


def stg_daily_city_metrics(spark, sf):
    return G.stg_daily_city_metrics(_raw(spark, sf, "daily"))


def stg_hourly_demand(spark, sf):
    return G.stg_hourly_demand(_raw(spark, sf, "hourly"))


def _models(spark, sf):
    return jobs.gold_models(spark, fx.gold_lake(spark, sf))


def dim_driver(spark, sf):
    return _models(spark, sf)["dim_driver"]


def dim_rider(spark, sf):
    return _models(spark, sf)["dim_rider"]


def fct_rides(spark, sf):
    return _models(spark, sf)["fct_rides"]


def fct_daily_city_metrics(spark, sf):
    return _models(spark, sf)["fct_daily_city_metrics"]


def fct_hourly_demand(spark, sf):
    return _models(spark, sf)["fct_hourly_demand"]


def _model(spark, sf, m):
    """One Gold table (only its folder is listed)."""
    return jobs.read_gold_partial(spark, fx.gold_lake(spark, sf), (m,))[m]


def _gold(spark, sf):
    return jobs.read_gold(spark, fx.gold_lake(spark, sf))


def test_unique(spark, sf):
    g = _gold(spark, sf)
    return (Q.test_unique(g["dim_driver"], "dim_driver", "driver_id")
            .unionByName(Q.test_unique(g["dim_rider"], "dim_rider", "rider_id"))
            .unionByName(Q.test_unique(g["fct_rides"], "fct_rides", "ride_id")))


def test_not_null(spark, sf):
    g = _gold(spark, sf)
    parts = [
        Q.test_not_null(g["dim_driver"], "dim_driver", ["driver_id"]),
        Q.test_not_null(g["dim_rider"], "dim_rider", ["rider_id"]),
        Q.test_not_null(g["fct_rides"], "fct_rides", ["ride_id", "city", "revenue"]),
        Q.test_not_null(g["fct_daily_city_metrics"], "fct_daily_city_metrics", ["metric_date", "total_rides"]),
        Q.test_not_null(g["fct_hourly_demand"], "fct_hourly_demand", ["demand_date", "hour_of_day"]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def test_accepted_values(spark, sf):
    return Q.test_accepted_values(_model(spark, sf, "fct_rides"), "fct_rides", "city", LENS_CONFIG.valid_cities)


def test_fct_rides_relationships(spark, sf):
    g = _gold(spark, sf)
    return Q.test_relationships(g["fct_rides"], "fct_rides", "driver_id", g["dim_driver"], "driver_id")


# -- quality gate -------------------------------------------------------------- #
def dq_bronze(spark, sf):
    rides = B.slice_type(_bronze(spark, sf), "ride_ended")
    return Q.run_suite(rides, "bronze_rides", Q.bronze_rides_checks(LENS_CONFIG))


def dq_silver(spark, sf):
    daily = S.daily_city_metrics(_bronze(spark, sf))
    return Q.run_suite(daily, "silver_daily_city_metrics", Q.silver_daily_checks(LENS_CONFIG))


def dq_report(spark, sf):
    """All nine checks with MIDDLE EAST left out of the valid cities."""
    b = _bronze(spark, sf)
    return Q.gate_report(b, S.daily_city_metrics(b), LENS_STRICT_CONFIG)


def dq_gate_verdict(spark, sf):
    """Per-layer verdicts with all cities valid (passes) and with one left out (fails)."""
    base_b = _bronze(spark, sf)
    base = Q.layer_summary(Q.gate_report(
        base_b, jobs.read_silver_daily(spark, fx.silver_lake(spark, sf)), LENS_CONFIG))
    edge = Q.layer_summary(Q.gate_report(base_b, S.daily_city_metrics(base_b), LENS_STRICT_CONFIG))
    return (base.select(F.lit("base").alias("scenario"), "*")
            .unionByName(edge.select(F.lit("edge").alias("scenario"), "*")))


# -- verification and BI ------------------------------------------------------- #
def verify_row_counts(spark, sf):
    return V.row_counts(jobs.lake_tables(spark, fx.gold_lake(spark, sf)))


def verify_orphans(spark, sf):
    return V.orphans(_model(spark, sf, "fct_rides"))


def verify_preview(spark, sf):
    return V.preview(_model(spark, sf, "fct_rides"))


def bi_kpis(spark, sf):
    return BI.kpis(_model(spark, sf, "fct_rides"))


def bi_revenue_by_vehicle(spark, sf):
    return BI.revenue_by_vehicle(_model(spark, sf, "fct_rides"))


def bi_revenue_by_segment(spark, sf):
    return BI.revenue_by_segment(_model(spark, sf, "fct_rides"))


def bi_demand_by_hour(spark, sf):
    return BI.demand_by_hour(_model(spark, sf, "fct_hourly_demand"))


def bi_driver_performance(spark, sf):
    return BI.driver_performance(_model(spark, sf, "fct_rides"))


# -- pipeline ------------------------------------------------------------------ #
def _pipeline(spark, sf, date, name):
    base = fx.bronze_lake(spark, sf)
    paths = fx.fresh_lake(spark, sf, name)
    fx.copy_seeds(spark, base, paths)
    # the given tables have rides of drivers without master data: their relationship test is a warning here
    rep = P.run_daily(spark, paths, date, LENS_CONFIG, strict_tests=False)
    return _report(spark, paths, rep)


def _report(spark, paths, rep):
    if not rep.ok:
        raise RuntimeError(f"pipeline failed: {rep.steps}")
    tables = {("silver", "daily_city_metrics"): jobs.read_silver_daily(spark, paths),
              ("silver", "hourly_demand"): jobs.read_silver_hourly(spark, paths)}
    tables.update(jobs.lake_tables(spark, paths))
    return V.row_counts(tables)


def pipeline_daily(spark, sf):
    return _pipeline(spark, sf, PIPELINE_DAY, "daily")


def pipeline_backfill(spark, sf):
    return _pipeline(spark, sf, None, "backfill")


def pipeline_strict(spark, sf):
    """The whole history with strict table tests, over master data that has every driver Bronze names."""
    base = fx.bronze_lake(spark, sf)
    paths = fx.fresh_lake(spark, sf, "strict")
    fx.copy_seeds(spark, base, paths, complete=True)
    return _report(spark, paths, P.backfill(spark, paths, LENS_CONFIG))


def _configured(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Apply the job settings (UTC, dynamic overwrite, AQE) before the query
    is built, whatever session the caller hands in."""
    import functools

    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return f(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _configured(f)
    for f in (
        bronze_parse, bronze_clean, bronze_city_tag, bronze_duration, bronze_metadata,
        bronze_roundtrip, bronze_event_counts, bronze_slice_by_type,
        bronze_stream_land, bronze_stream_resume, bronze_batch_summary,
        silver_ride_counts, silver_revenue, silver_daily_city_metrics, silver_hourly_requests,
        silver_hourly_demand, silver_peak_hour, silver_daily_one_day, silver_overwrite_one_day,
        silver_empty_day_noop,
        raw_rides, raw_upper_columns, raw_rides_by_name, raw_daily_load, raw_hourly_load,
        seed_load, seed_load_riders, stg_rides, stg_daily_city_metrics, stg_hourly_demand,
        dim_driver, dim_rider, fct_rides, fct_daily_city_metrics, fct_hourly_demand,
        test_unique, test_not_null, test_accepted_values, test_fct_rides_relationships,
        dq_bronze, dq_silver, dq_report, dq_gate_verdict,
        verify_row_counts, verify_orphans, verify_preview,
        bi_kpis, bi_revenue_by_vehicle, bi_revenue_by_segment, bi_demand_by_hour,
        bi_driver_performance,
        pipeline_daily, pipeline_backfill, pipeline_strict,
    )
}
