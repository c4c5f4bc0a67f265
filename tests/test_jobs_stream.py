"""Layer jobs, the daily pipeline and the Bronze stream, on small frames."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import ev
from triplake.config import LakeConfig
from triplake.operators import bronze as B
from triplake.plans import jobs
from triplake.schemas import ENVELOPE_SCHEMA
from triplake.sinks.lake import append_bronze, write_seed
from triplake.sources import bus
from triplake.sources import lake as src
from triplake.streaming import bronze_stream
from tests.conftest import envelope_rows

T = "2024-01-0{d}T10:00:00.000000+00:00"


def _land(raw_frame, paths, events):
    append_bronze(B.transform(raw_frame(events)), paths.bronze)


def _ride(i, d, amount=100.0):
    r = f"r{d}_{i}"
    return [ev(r, "ride_requested", time=T.format(d=d)),
            ev(r, "ride_ended", time=T.format(d=d), duration_min=10.0, fare_amount=amount, distance_km=3.0),
            ev(r, "payment_completed", time=T.format(d=d), amount=amount, payment_method="cash")]


def test_missing_layer_error(spark, tmp_lake):
    with pytest.raises(src.MissingLayerError, match="no .* layer at"):
        src.read_bronze(spark, f"{tmp_lake}/nothing-here")


def test_rerun_one_date_replaces_only_that_partition(spark, raw_frame, tmp_lake):
    paths = jobs.LakePaths(tmp_lake)
    _land(raw_frame, paths, _ride(1, 1) + _ride(1, 2))
    assert jobs.run_silver(spark, paths, None)
    _land(raw_frame, paths, _ride(2, 2, amount=50.0) + _ride(2, 1, amount=7.0))
    assert jobs.run_silver(spark, paths, "2024-01-02")
    rev = {str(r["event_date"]): r["revenue_pkr"] for r in jobs.read_silver_daily(spark, paths).collect()}
    assert rev == {"2024-01-01": 100.0, "2024-01-02": 150.0}


def test_empty_date_writes_nothing(spark, raw_frame, tmp_lake):
    paths = jobs.LakePaths(tmp_lake)
    _land(raw_frame, paths, _ride(1, 1))
    jobs.run_silver(spark, paths, None)
    assert jobs.run_silver(spark, paths, "2024-01-05") is False
    assert jobs.read_silver_daily(spark, paths).count() == 1


def test_run_twice_is_idempotent(spark, raw_frame, tmp_lake):
    paths = jobs.LakePaths(tmp_lake)
    _land(raw_frame, paths, _ride(1, 1) + _ride(2, 1))
    jobs.run_silver(spark, paths, "2024-01-01")
    first = sorted(map(tuple, jobs.read_silver_daily(spark, paths).collect()))
    jobs.run_silver(spark, paths, "2024-01-01")
    assert sorted(map(tuple, jobs.read_silver_daily(spark, paths).collect())) == first


def _seeds(spark, paths):
    write_seed(spark.createDataFrame([("driver_1", "A", 4.5, "Z", "go", "2023-01-01")],
                                     "driver_id string, driver_name string, rating double, home_zone string, "
                                     "primary_vehicle string, joined_date string"), paths.seed_drivers)
    write_seed(spark.createDataFrame([("rider_1", "B", "vip", "2023-02-01")],
                                     "rider_id string, rider_name string, segment string, signup_date string"),
               paths.seed_riders)


def test_pipeline_daily_runs_all_steps(spark, raw_frame, tmp_lake):
    from triplake.plans import pipeline as P
    paths = jobs.LakePaths(tmp_lake)
    _land(raw_frame, paths, _ride(1, 1) + _ride(2, 2))
    _seeds(spark, paths)
    rep = P.run_daily(spark, paths, "2024-01-02")
    assert [s for s, _, _ in rep.steps] == ["silver_batch", "dq_gate", "load_raw", "gold_dims",
                                             "gold_facts", "table_tests"]
    assert rep.ok
    gold = jobs.read_gold(spark, paths)
    assert gold["fct_rides"].count() == 2  # RAW reloads the whole history
    assert gold["fct_daily_city_metrics"].count() == 1  # Silver ran for one date
    assert gold["fct_rides"].first()["driver_rating"] == 4.5


def test_pipeline_stops_at_failed_gate(spark, raw_frame, tmp_lake):
    from triplake.operators.quality import DataQualityError
    from triplake.plans import pipeline as P
    paths = jobs.LakePaths(tmp_lake)
    _land(raw_frame, paths, _ride(1, 1, amount=-5.0))
    _seeds(spark, paths)
    with pytest.raises(DataQualityError):
        P.run_daily(spark, paths, None)
    with pytest.raises(src.MissingLayerError):
        jobs.read_raw(spark, paths, "rides").count()


def test_stream_resumes_from_checkpoint(spark, tmp_lake):
    topic, bronze, ckpt = f"{tmp_lake}/topic", f"{tmp_lake}/bronze", f"{tmp_lake}/ckpt"
    first = envelope_rows(_ride(1, 1))
    spark.createDataFrame(first, ENVELOPE_SCHEMA).coalesce(1).write.mode("append").parquet(topic)
    summaries = []
    bronze_stream.run_available(bus.file_stream(spark, topic, 1), bronze, ckpt, LakeConfig(), summaries)
    assert src.read_bronze(spark, bronze).count() == 3
    second = envelope_rows(_ride(2, 1) + ["not json"])
    spark.createDataFrame(second, ENVELOPE_SCHEMA).coalesce(1).write.mode("append").parquet(topic)
    bronze_stream.run_available(bus.file_stream(spark, topic, 1), bronze, ckpt, LakeConfig(), summaries)
    df = src.read_bronze(spark, bronze)
    assert df.count() == 6 and df.select("event_id").distinct().count() == 6
    assert [s[1] for s in summaries] == [3, 3]


def test_stream_skips_empty_batch(spark, tmp_lake):
    topic, bronze, ckpt = f"{tmp_lake}/topic", f"{tmp_lake}/bronze", f"{tmp_lake}/ckpt"
    spark.createDataFrame(envelope_rows(["not json"]), ENVELOPE_SCHEMA).write.parquet(topic)
    summaries = []
    bronze_stream.run_available(bus.file_stream(spark, topic), bronze, ckpt, LakeConfig(), summaries)
    assert summaries == []
    with pytest.raises(src.MissingLayerError):
        src.read_bronze(spark, bronze).count()


def test_bronze_write_is_rebalanced(spark, raw_frame, tmp_lake):
    from tests.conftest import plan_text
    df = B.transform(raw_frame(_ride(1, 1))).hint("rebalance", "event_date", "event_type")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_text(df)


def test_pipeline_registers_layers_by_name(spark, raw_frame, tmp_lake):
    from triplake.plans import pipeline as P
    paths = jobs.LakePaths(tmp_lake)
    _land(raw_frame, paths, _ride(1, 1))
    _seeds(spark, paths)
    P.run_daily(spark, paths, None)
    assert spark.table("raw.rides").count() == 1
    assert spark.table("gold.fct_rides").count() == 1
    assert spark.sql("SELECT COUNT(*) AS n FROM stg_rides").first()["n"] == 1
    names = {d.name for d in spark.catalog.listDatabases()}
    assert {"raw", "staging", "gold"} <= names


def test_staging_views_and_seeds_are_visible_to_other_sessions(spark, raw_frame, tmp_lake):
    from triplake.operators import gold as G
    from triplake.plans import pipeline as P
    paths = jobs.LakePaths(tmp_lake)
    _land(raw_frame, paths, _ride(1, 1) + _ride(2, 2))
    _seeds(spark, paths)
    P.run_daily(spark, paths, None)
    other = spark.newSession()
    raw = spark.table("raw.rides")
    want = G.stg_rides(raw.toDF(*[c.lower() for c in raw.columns]))
    got = other.table("staging.stg_rides")
    assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())
    assert other.table("staging.stg_hourly_demand").columns[0] == "demand_date"
    assert other.table("staging.stg_daily_city_metrics").count() == 2
    for name, path, read in (("drivers", paths.seed_drivers, src.read_seed_drivers),
                             ("riders", paths.seed_riders, src.read_seed_riders)):
        seed = read(spark, path)
        got = other.table(f"gold.seed_{name}")
        assert got.dtypes == seed.dtypes and sorted(got.collect()) == sorted(seed.collect())


def test_cli_gate_exit_codes(spark, raw_frame, tmp_lake, capsys):
    from triplake import cli
    paths = jobs.LakePaths(tmp_lake)
    _land(raw_frame, paths, _ride(1, 1) + _ride(2, 1, amount=-1.0))
    jobs.run_silver(spark, paths, None)
    assert cli.main(["gate", "--lake-root", tmp_lake], spark=spark) == 1
    assert spark.range(1).count() == 1  # session still usable
    assert "fare_amount" in capsys.readouterr().out


@pytest.mark.parametrize("cache", [True, False])
def test_batch_summary_same_with_and_without_cache(spark, tmp_lake, cache):
    topic = f"{tmp_lake}/topic"
    rows = envelope_rows(_ride(1, 1) + _ride(2, 1) + ["not json"])
    spark.createDataFrame(rows, ENVELOPE_SCHEMA).coalesce(1).write.parquet(topic)
    summaries = []
    bronze_stream.run_available(bus.file_stream(spark, topic), f"{tmp_lake}/b", f"{tmp_lake}/c",
                                LakeConfig(), summaries, cache_batches=cache)
    assert summaries == [(0, 6, [("payment_completed", 2), ("ride_ended", 2), ("ride_requested", 2)])]


def test_read_bronze_by_date_lists_only_that_date(spark, raw_frame, tmp_lake):
    from tests.conftest import plan_text
    paths = jobs.LakePaths(tmp_lake)
    _land(raw_frame, paths, _ride(1, 1) + _ride(1, 2))
    df = src.read_bronze(spark, paths.bronze, ["2024-01-02"])
    assert {str(r["event_date"]) for r in df.collect()} == {"2024-01-02"}
    assert "event_date=2024-01-01" not in plan_text(df)
    # absent date: no rows, no error; absent Bronze: typed error
    assert src.read_bronze(spark, paths.bronze, ["2024-01-09"]).count() == 0
    with pytest.raises(src.MissingLayerError):
        src.read_bronze(spark, f"{tmp_lake}/none", ["2024-01-09"])


def test_failed_dim_test_skips_facts(spark, raw_frame, tmp_lake):
    from triplake.plans import pipeline as P
    paths = jobs.LakePaths(tmp_lake)
    _land(raw_frame, paths, _ride(1, 1))
    row = ("driver_1", "A", 4.5, "Z", "go", "2023-01-01")
    write_seed(spark.createDataFrame([row, row],
                                     "driver_id string, driver_name string, rating double, home_zone string, "
                                     "primary_vehicle string, joined_date string"), paths.seed_drivers)
    write_seed(spark.createDataFrame([("rider_1", "B", "vip", "2023-02-01")],
                                     "rider_id string, rider_name string, segment string, signup_date string"),
               paths.seed_riders)
    rep = P.run_daily(spark, paths, None, strict_tests=False)
    assert ("gold_dims", "failed", "") in rep.steps and rep.steps[-1][:2] == ("gold_facts", "skipped")
    with pytest.raises(P.TableTestError):
        P.run_daily(spark, paths, None)


def test_kafka_source_reports_missing_connector(spark):
    try:
        df = bus.kafka_stream(spark, "localhost:1", "t")
    except bus.ConnectorMissingError:
        return
    assert df.isStreaming  # connector present: the source builds lazily


def test_bad_run_date_rejected_before_any_job(spark, raw_frame, tmp_lake):
    paths = jobs.LakePaths(tmp_lake)
    _land(raw_frame, paths, _ride(1, 1))
    with pytest.raises(ValueError):
        jobs.run_silver(spark, paths, "2024-13-45")


def test_cli_jobs_end_to_end(spark, raw_frame, tmp_lake, capsys):
    from triplake import cli
    paths = jobs.LakePaths(tmp_lake, silver_root=f"{tmp_lake}/elsewhere/silver")
    _land(raw_frame, paths, _ride(1, 1) + _ride(2, 2))
    _seeds(spark, paths)
    base = ["--lake-root", tmp_lake, "--silver", f"{tmp_lake}/elsewhere/silver"]
    assert cli.main(["silver", "--date", "2024-01-02", "--preview", *base], spark=spark) == 0
    assert jobs.read_silver_daily(spark, paths).count() == 1
    assert cli.main(["gate", *base], spark=spark) == 0
    assert cli.main(["load-raw", *base], spark=spark) == 0
    assert cli.main(["gold", *base], spark=spark) == 0
    assert cli.main(["verify", *base], spark=spark) == 0
    out = capsys.readouterr().out
    assert "gate: open" in out and "fct_rides" in out and "OK: of 2 rides" in out
    assert spark.table("gold.fct_rides").count() == 2
    assert cli.main(["silver", "--date", "2024-01-09", *base], spark=spark) == 0
    assert "empty selection" in capsys.readouterr().out


def test_cli_exit_codes_follow_the_run(spark, raw_frame, tmp_lake):
    from triplake import cli
    paths = jobs.LakePaths(tmp_lake)
    _land(raw_frame, paths, _ride(1, 1))
    row = ("driver_1", "A", 4.5, "Z", "go", "2023-01-01")
    write_seed(spark.createDataFrame([row, row],
                                     "driver_id string, driver_name string, rating double, home_zone string, "
                                     "primary_vehicle string, joined_date string"), paths.seed_drivers)
    write_seed(spark.createDataFrame([("rider_1", "B", "vip", "2023-02-01")],
                                     "rider_id string, rider_name string, segment string, signup_date string"),
               paths.seed_riders)
    assert cli.main(["daily", "--lake-root", tmp_lake], spark=spark) == 1  # dim test failed, facts skipped
    assert cli.main(["daily", "--lake-root", tmp_lake, "--no-strict-tests"], spark=spark) == 1
    assert cli.main(["gold", "--lake-root", tmp_lake], spark=spark) == 1
    assert cli.main(["gold", "--lake-root", tmp_lake, "--no-strict-tests"], spark=spark) == 1
    assert not os.path.exists(paths.gold_fct_rides)  # no fact over a duplicated driver is published


def test_processing_time_trigger_runs_until_stopped(spark, tmp_lake):
    topic, bronze, ckpt = f"{tmp_lake}/topic", f"{tmp_lake}/bronze", f"{tmp_lake}/ckpt"
    spark.createDataFrame(envelope_rows(_ride(1, 1)), ENVELOPE_SCHEMA).write.parquet(topic)
    q = bronze_stream.start(bus.file_stream(spark, topic), bronze, ckpt, LakeConfig(), interval="1 second")
    try:
        q.processAllAvailable()
        assert q.isActive  # a processing-time stream keeps running
        spark.createDataFrame(envelope_rows(_ride(2, 1)), ENVELOPE_SCHEMA).write.mode("append").parquet(topic)
        q.processAllAvailable()
    finally:
        q.stop()
    assert src.read_bronze(spark, bronze).count() == 6


def test_gold_facts_are_date_partitioned_and_prune(spark, raw_frame, tmp_lake):
    from pyspark.sql import functions as F
    from tests.conftest import plan_text
    from triplake.plans import pipeline as P
    paths = jobs.LakePaths(tmp_lake)
    _land(raw_frame, paths, _ride(1, 1) + _ride(2, 2))
    _seeds(spark, paths)
    P.run_daily(spark, paths, None)
    fct = jobs.read_gold(spark, paths)["fct_rides"]
    one_day = fct.filter(F.col("ride_date") == F.lit("2024-01-02").cast("date"))
    assert "PartitionFilters: [isnotnull(ride_date" in plan_text(one_day)
    assert [r["ride_id"] for r in one_day.collect()] == ["r2_2"]
    assert spark.table("gold.fct_rides").filter("ride_date = DATE'2024-01-01'").count() == 1


def test_empty_partitioned_reload_stays_readable(spark, tmp_lake):
    from triplake.sinks.lake import reload_table
    empty = spark.createDataFrame([], "ride_id string, ride_date date")
    reload_table(empty, f"{tmp_lake}/fct", ("ride_date",))
    df = src.read_layer(spark, f"{tmp_lake}/fct", "gold", empty.schema)
    assert df.count() == 0 and set(df.columns) == {"ride_id", "ride_date"}
    full = spark.createDataFrame([("r1", None)], "ride_id string, ride_date date").selectExpr(
        "ride_id", "DATE'2024-01-01' AS ride_date")
    reload_table(full, f"{tmp_lake}/fct", ("ride_date",))
    assert src.read_layer(spark, f"{tmp_lake}/fct", "gold").count() == 1


def test_cli_stream_available_now_from_files(spark, tmp_lake):
    from triplake import cli
    topic = f"{tmp_lake}/topic"
    spark.createDataFrame(envelope_rows(_ride(1, 1) + _ride(2, 1)), ENVELOPE_SCHEMA).repartition(2).write.parquet(topic)
    assert cli.main(["stream", "--lake-root", tmp_lake, "--files", topic, "--available-now",
                     "--max-files-per-trigger", "1"], spark=spark) == 0
    assert src.read_bronze(spark, jobs.LakePaths(tmp_lake).bronze).count() == 6


def test_register_existing_lake_by_name(spark, raw_frame, tmp_lake):
    from triplake.plans import namespaces as ns
    from triplake.plans import pipeline as P
    paths = jobs.LakePaths(tmp_lake)
    _land(raw_frame, paths, _ride(1, 1) + _ride(2, 2))
    _seeds(spark, paths)
    P.run_daily(spark, paths, None)
    for t in ("gold.fct_rides", "raw.rides"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    ns.register_all(spark, paths)  # infers schemas, recovers the date partitions
    assert spark.table("gold.fct_rides").count() == 2
    assert spark.table("gold.fct_rides").filter("ride_date = DATE'2024-01-02'").count() == 1
    assert spark.sql("SELECT COUNT(*) AS n FROM stg_rides").first()["n"] == 2


def test_late_event_changes_silver_only_when_its_date_reruns(spark, raw_frame, tmp_lake):
    paths = jobs.LakePaths(tmp_lake)
    _land(raw_frame, paths, _ride(1, 1) + _ride(1, 2))
    jobs.run_silver(spark, paths, None)
    _land(raw_frame, paths, _ride(9, 1, amount=40.0))  # late rows for day 1 arrive on day 2
    jobs.run_silver(spark, paths, "2024-01-02")
    rev = {str(r["event_date"]): r["revenue_pkr"] for r in jobs.read_silver_daily(spark, paths).collect()}
    assert rev == {"2024-01-01": 100.0, "2024-01-02": 100.0}  # day 1 not yet recomputed
    jobs.run_silver(spark, paths, "2024-01-01")
    rev = {str(r["event_date"]): r["revenue_pkr"] for r in jobs.read_silver_daily(spark, paths).collect()}
    assert rev == {"2024-01-01": 140.0, "2024-01-02": 100.0}


def test_two_revenue_numbers(spark, raw_frame, tmp_lake):
    """Silver: payments on the payment date. Gold: coalesce(paid, fare) on the ride date."""
    from triplake.plans import pipeline as P
    paths = jobs.LakePaths(tmp_lake)
    _land(raw_frame, paths, [
        ev("a", "ride_ended", time="2024-01-01T23:59:00.000000+00:00", duration_min=5.0, fare_amount=50.0),
        ev("a", "payment_completed", time="2024-01-02T00:01:00.000000+00:00", amount=55.0),
        ev("b", "ride_ended", time="2024-01-01T10:00:00.000000+00:00", duration_min=5.0, fare_amount=30.0),
        ev("c", "ride_ended", time="2024-01-01T11:00:00.000000+00:00", duration_min=5.0, fare_amount=20.0),
        ev("c", "payment_completed", time="2024-01-01T11:05:00.000000+00:00", amount=20.0),
    ])
    _seeds(spark, paths)
    P.run_daily(spark, paths, None)
    silver = {str(r["event_date"]): r["revenue_pkr"] for r in jobs.read_silver_daily(spark, paths).collect()}
    assert silver == {"2024-01-01": 20.0, "2024-01-02": 55.0}  # unpaid b absent; a on its payment day
    gold = {r["ride_id"]: (str(r["ride_date"]), r["revenue"])
            for r in jobs.read_gold(spark, paths)["fct_rides"].collect()}
    assert gold == {"a": ("2024-01-01", 55.0), "b": ("2024-01-01", 30.0), "c": ("2024-01-01", 20.0)}


def test_pipeline_on_a_day_with_only_requests(spark, raw_frame, tmp_lake):
    """No ended rides or payments yet: every layer is written (empty) and readable."""
    from triplake import cli
    from triplake.operators import bi as BI
    from triplake.plans import pipeline as P
    paths = jobs.LakePaths(tmp_lake)
    _land(raw_frame, paths, [ev(f"r{i}", "ride_requested") for i in range(3)])
    _seeds(spark, paths)
    rep = P.run_daily(spark, paths, None)
    assert rep.ok, rep.steps
    gold = jobs.read_gold(spark, paths)
    assert gold["fct_rides"].count() == 0 and gold["fct_daily_city_metrics"].count() == 0
    assert gold["fct_hourly_demand"].count() == 1
    kpi = BI.kpis(gold["fct_rides"]).first()
    assert kpi["total_rides"] is None or kpi["total_rides"] == 0
    assert cli.main(["verify", "--lake-root", tmp_lake], spark=spark) == 0


def test_seed_header_must_match_schema(spark, tmp_lake):
    ok = f"{tmp_lake}/ok"
    write_seed(spark.createDataFrame([("rider_1", "B", "vip", "2023-02-01")],
                                     "rider_id string, rider_name string, segment string, signup_date string"), ok)
    assert src.read_seed_riders(spark, ok).first()["segment"] == "vip"
    bad = f"{tmp_lake}/bad"
    write_seed(spark.createDataFrame([("B", "rider_1", "vip", "2023-02-01")],
                                     "rider_name string, rider_id string, segment string, signup_date string"), bad)
    with pytest.raises(Exception):
        src.read_seed_riders(spark, bad).collect()


def test_cli_missing_layer_exits_1_with_hint(spark, tmp_lake, capsys):
    from triplake import cli
    assert cli.main(["gate", "--lake-root", f"{tmp_lake}/empty-lake"], spark=spark) == 1
    out = capsys.readouterr().out
    assert "error:" in out and "`stream`" in out
