"""Plan shape at scale: broadcast only when proven small, skew spreads."""

import os

from pyspark.sql import functions as F

from tests.conftest import ev, plan_text
from triplake.operators import bronze as B
from triplake.operators import gold as G
from triplake.operators import silver as S


def _dims(spark, n_drivers):
    drivers = spark.range(n_drivers).select(
        F.concat(F.lit("driver_"), F.col("id").cast("string")).alias("driver_id"),
        F.lit("x").alias("driver_name"), F.lit(4.0).alias("rating"), F.lit("z").alias("home_zone"),
        F.lit("go").alias("primary_vehicle"), F.lit(None).cast("date").alias("joined_date"))
    riders = spark.range(10).select(
        F.concat(F.lit("rider_"), F.col("id").cast("string")).alias("rider_id"),
        F.lit("r").alias("rider_name"), F.lit("vip").alias("segment"),
        F.lit(None).cast("date").alias("signup_date"))
    return drivers, riders


def _stg(spark, n):
    return spark.range(n).select(
        F.concat(F.lit("ride_"), F.col("id").cast("string")).alias("ride_id"),
        F.lit("rider_1").alias("rider_id"), F.concat(F.lit("driver_"), (F.col("id") % 7).cast("string")).alias("driver_id"),
        F.lit("go").alias("vehicle_type"), F.lit("Karachi").alias("city"),
        F.lit(None).cast("date").alias("ride_date"), F.lit(1.0).alias("duration_min"),
        F.lit(1.0).alias("distance_km"), F.lit(10.0).alias("fare_amount"),
        F.lit(None).cast("double").alias("paid_amount"), F.lit("cash").alias("payment_method"))


def test_small_dims_are_broadcast(spark):
    drivers, riders = _dims(spark, 50)
    assert "BroadcastHashJoin" in plan_text(G.fct_rides(_stg(spark, 100), drivers, riders))


def test_large_dims_are_shuffled_and_plans_start_no_job(spark):
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        drivers, riders = _dims(spark, 50)
        spark.sparkContext.setJobGroup("plan only", "")
        plan = plan_text(G.fct_rides(_stg(spark, 100), drivers, riders))
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan only")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_hot_city_distinct_exchange_spreads_by_ride(raw_frame):
    events = [ev(f"r{i}", "ride_ended", duration_min=1.0, fare_amount=1.0) for i in range(50)]
    plan = plan_text(S.ride_counts(B.transform(raw_frame(events))))
    # first exchange keyed by the group AND the ride: a hot city spreads over tasks
    keys = [seg.split(")")[0] for seg in plan.split("hashpartitioning(")[1:]]
    assert any("city" in k and "ride_id" in k for k in keys), keys


def test_rebalanced_write_splits_a_hot_partition(spark, tmp_lake):
    from triplake.sinks.lake import append_bronze

    rows = spark.range(20000).select(
        F.lit("ride_requested").alias("event_type"), F.lit("2024-01-01").cast("date").alias("event_date"),
        F.concat(F.lit("ride_"), F.col("id").cast("string")).alias("ride_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload")).repartition(8)
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    prev = [spark.conf.get(k) for k in keys]
    spark.conf.set(keys[0], "64k")
    spark.conf.set(keys[1], "1k")
    try:
        append_bronze(rows, tmp_lake)
    finally:
        for k, v in zip(keys, prev):
            spark.conf.set(k, v)
    part = tmp_lake.replace("file:", "") + "/event_date=2024-01-01/event_type=ride_requested"
    files = [f for f in os.listdir(part) if f.endswith(".parquet")]
    assert len(files) > 1
    assert spark.read.parquet(tmp_lake).count() == 20000


def test_ride_join_shuffles_ended_once_and_splits_either_side(spark, raw_frame, tmp_lake):
    from triplake.operators import raw as R
    from triplake.sinks.lake import append_bronze
    from triplake.sources.lake import read_bronze

    events = []
    for i in range(40):
        events += [ev(f"r{i}", "ride_ended", duration_min=1.0, fare_amount=2.0)]
        if i % 3:
            events += [ev(f"r{i}", "payment_completed", amount=2.0)]
    append_bronze(B.transform(raw_frame(events)), tmp_lake)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    prev = [spark.conf.get(k, None) for k in keys]
    for k in keys:
        spark.conf.set(k, "-1")  # as at scale: no side is small enough to broadcast
    try:
        df = R.build_rides(read_bronze(spark, tmp_lake))
        rows = df.collect()
        plan = plan_text(df)
    finally:
        for k, v in zip(keys, prev):
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert len(rows) == 40 and sum(r["paid_amount"] is None for r in rows) == 14
    final = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and "SortMergeJoin" in final and "LeftAnti" in final


def test_registration_leaves_managed_tables_alone(spark, tmp_lake):
    import pytest

    from triplake.plans import namespaces as ns

    spark.sql("CREATE DATABASE IF NOT EXISTS kept_by_user")
    spark.range(3).write.mode("overwrite").saveAsTable("kept_by_user.rides")
    spark.range(5).write.parquet(f"{tmp_lake}/rides")
    with pytest.raises(ValueError):
        ns._register(spark, "kept_by_user.rides", f"{tmp_lake}/rides")
    assert spark.table("kept_by_user.rides").count() == 3
    ns._register(spark, "kept_by_user.other", f"{tmp_lake}/rides")
    ns._register(spark, "kept_by_user.other", f"{tmp_lake}/rides")
    assert spark.table("kept_by_user.other").count() == 5


def _events(spark, n):
    return spark.range(n).select(
        F.col("id").alias("event_id"), F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).alias("user_id"), F.lit("view").alias("event_type"), F.rand(1).alias("value"))


def test_rides_of_one_row_group_are_dealt_evenly(spark, tmp_lake, monkeypatch):
    """A file of one row group has many splits by its bytes and one that holds rows."""
    from ridelens import lens

    _events(spark, 20000).coalesce(1).write.parquet(f"{tmp_lake}/events")
    spark.createDataFrame([(0, "AFRICA")], "r_regionkey int, r_name string").write.parquet(f"{tmp_lake}/region")
    region = spark.read.parquet(f"{tmp_lake}/region")  # of known size, so it is broadcast
    prev = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in prev:
        spark.conf.set(k, "4096")
    try:
        rides = lens.rides(spark.read.parquet(f"{tmp_lake}/events"), region)
        largest = max(r["count"] for r in rides.groupBy(F.spark_partition_id()).count().collect())
        assert largest < 20000 / 2
        monkeypatch.setattr(lens, "ROWS_PER_TASK", 1000)
        assert lens.rides(spark.read.parquet(f"{tmp_lake}/events"), region).rdd.getNumPartitions() == 20
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)


def test_landing_is_dealt_evenly_and_parses_a_message_once(spark, tmp_lake):
    """The step that every query over Bronze shares: no task expands and parses most rides of a one-row-group file."""
    from ridelens import fixtures as fx
    from ridelens import lens

    os.makedirs(tmp_lake)
    _events(spark, 20000).coalesce(1).write.parquet(f"{tmp_lake}/events.parquet")
    spark.createDataFrame([(0, "AFRICA")], "r_regionkey int, r_name string").write.parquet(f"{tmp_lake}/region.parquet")
    prev = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in prev:
        spark.conf.set(k, "4096")
    try:
        landed = B.transform(fx.envelopes(spark, tmp_lake), lens.LENS_CONFIG)
        assert plan_text(landed).count("from_json") == 1
        tasks = [r["count"] for r in landed.groupBy(F.spark_partition_id()).count().collect()]
        assert max(tasks) < sum(tasks) / 2
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)


def test_topic_files_hold_whole_rides(spark, tmp_lake):
    """No message is shuffled on its way to the topic, and two micro-batches drain it."""
    from ridelens import fixtures as fx

    os.makedirs(tmp_lake)
    _events(spark, 400).write.parquet(f"{tmp_lake}/events.parquet")
    spark.createDataFrame([(0, "AFRICA")], "r_regionkey int, r_name string").write.parquet(f"{tmp_lake}/region.parquet")
    topic = fx.topic(spark, tmp_lake)
    files = spark.read.parquet(topic).select("key", F.input_file_name().alias("f"))
    assert files.where("key IS NOT NULL").groupBy("key").agg(F.count_distinct("f").alias("n")).where("n > 1").isEmpty()
    n = files.select("f").distinct().count()
    assert n == 2 * fx.parallelism(spark) and n <= 2 * fx.files_per_batch(spark, topic)
