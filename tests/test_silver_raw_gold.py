"""Silver aggregates, RAW ride grain, Gold models: edge rows."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import ev, plan_text
from triplake.operators import bronze as B
from triplake.operators import gold as G
from triplake.operators import quality as Q
from triplake.operators import raw as R
from triplake.operators import silver as S
from triplake.plans import jobs

T = "2024-01-0{d}T{h:02d}:{m:02d}:00.000000+00:00"


def _bronze(raw_frame, events):
    return B.transform(raw_frame(events))


def test_duplicate_payment(raw_frame):
    b = _bronze(raw_frame, [
        ev("r1", "ride_ended", duration_min=10.0, fare_amount=100.0),
        ev("r1", "payment_completed", amount=100.0, payment_method="cash"),
        ev("r1", "payment_completed", amount=100.0, payment_method="cash"),
    ])
    m = S.daily_city_metrics(b).first()
    assert (m["revenue_pkr"], m["paid_rides"], m["total_rides"]) == (200.0, 1, 1)
    rides = R.build_rides(b)
    assert rides.count() == 2
    assert Q.test_unique(rides, "fct_rides", "ride_id").first()["failures"] == 1


def test_one_sided_days_fill_zero_and_fail_strict_revenue(raw_frame):
    b = _bronze(raw_frame, [
        ev("r1", "payment_completed", time=T.format(d=1, h=1, m=0), amount=50.0),
        ev("r2", "ride_ended", time=T.format(d=2, h=1, m=0), duration_min=5.0, fare_amount=50.0),
    ])
    rows = {str(r["event_date"]): r for r in S.daily_city_metrics(b).collect()}
    pay_only, ended_only = rows["2024-01-01"], rows["2024-01-02"]
    assert (pay_only["total_rides"], pay_only["avg_duration_min"], pay_only["revenue_pkr"]) == (0, 0.0, 50.0)
    assert (ended_only["revenue_pkr"], ended_only["paid_rides"], ended_only["total_rides"]) == (0.0, 0, 1)
    report = {(r["column"]): r for r in Q.run_suite(
        S.daily_city_metrics(b), "silver", Q.silver_daily_checks(jobs.LakeConfig())).collect()}
    assert report["revenue_pkr"]["unexpected_count"] == 1


def test_tied_peak_hours_pick_earliest(raw_frame):
    events = []
    for h in (9, 14):
        for i in range(3):
            events.append(ev(f"r{h}_{i}", "ride_requested", time=T.format(d=1, h=h, m=i)))
    events.append(ev("r_x", "ride_requested", time=T.format(d=1, h=11, m=0)))
    rows = S.hourly_demand(_bronze(raw_frame, events)).collect()
    flagged = [r["hour"] for r in rows if r["is_peak_hour"]]
    assert flagged == [9]
    assert [(r["hour"], r["ride_requests"]) for r in S.peak_hours(_bronze(raw_frame, events)).collect()] == [(9, 3)]


def test_rounding_is_half_up_and_order_free(raw_frame):
    # 23.035 average is a tie at the 3rd decimal; half-up gives 23.04
    b = _bronze(raw_frame, [
        ev("r1", "ride_ended", duration_min=23.03, fare_amount=1.0),
        ev("r2", "ride_ended", duration_min=23.04, fare_amount=1.0),
        ev("r1", "payment_completed", amount=0.1),
        ev("r2", "payment_completed", amount=0.2),
    ])
    m = S.daily_city_metrics(b).first()
    assert m["avg_duration_min"] == 23.04
    assert m["revenue_pkr"] == 0.3


def test_distinct_counts_absorb_replayed_events(raw_frame):
    e = ev("r1", "ride_ended", duration_min=4.0, fare_amount=10.0)
    m = S.ride_counts(_bronze(raw_frame, [e, e])).first()
    assert m["total_rides"] == 1


def test_raw_keeps_unpaid_rides_and_renames(raw_frame):
    b = _bronze(raw_frame, [
        ev("r1", "ride_ended", duration_min=10.0, fare_amount=100.0),
        ev("r2", "ride_ended", duration_min=10.0, fare_amount=90.0),
        ev("r2", "payment_completed", amount=95.0, payment_method="card"),
    ])
    rides = {r["ride_id"]: r for r in R.build_rides(b).collect()}
    assert rides["r1"]["paid_amount"] is None
    assert (rides["r2"]["paid_amount"], rides["r2"]["payment_method"]) == (95.0, "card")
    assert R.upper_columns(R.build_rides(b)).columns[0] == "RIDE_ID"


def test_fct_rides_revenue_and_orphans(spark):
    stg = spark.createDataFrame(
        [("r1", "rider_1", "driver_1", "go", "Karachi", None, 5.0, 2.0, 100.0, None, None),
         ("r2", "rider_9", None, "GO", "Karachi", None, 5.0, 2.0, 100.0, 80.0, "cash")],
        "ride_id string, rider_id string, driver_id string, vehicle_type string, city string, "
        "event_date date, ride_duration_min double, distance_km double, fare_amount double, "
        "paid_amount double, payment_method string")
    drivers = spark.createDataFrame([("driver_1", "A", 4.5, "Z", "go", None)],
                                    "driver_id string, driver_name string, rating double, home_zone string, "
                                    "primary_vehicle string, joined_date date")
    riders = spark.createDataFrame([("rider_1", "B", "vip", None)],
                                   "rider_id string, rider_name string, segment string, signup_date date")
    f = {r["ride_id"]: r for r in G.fct_rides(G.stg_rides(stg), drivers, riders).collect()}
    assert f["r1"]["revenue"] == 100.0 and f["r2"]["revenue"] == 80.0
    assert f["r2"]["vehicle_type"] == "go"
    assert f["r1"]["driver_rating"] == 4.5 and f["r2"]["rider_name"] is None
    # null driver_id is not a relationships violation
    fct = G.fct_rides(G.stg_rides(stg), drivers, riders)
    assert Q.test_relationships(fct, "fct_rides", "driver_id", drivers, "driver_id").first()["failures"] == 0


def test_revenue_per_ride_zero_rides(spark):
    stg = spark.createDataFrame([(None, "Karachi", 0, 0.0, 50.0, 1), (None, "Karachi", 3, 1.0, 10.0, 3)],
                                "metric_date date, city string, total_rides long, avg_duration_min double, "
                                "revenue_pkr double, paid_rides long")
    vals = sorted(r["revenue_per_ride"] for r in G.fct_daily_city_metrics(stg).collect())
    assert vals == [0.0, 3.33]


def test_stg_filters_null_ride_id(spark):
    raw = spark.createDataFrame([(None, "x"), ("r1", "y")], "ride_id string, rider_id string")
    raw = raw.select("*", *[F.lit(None).cast(t).alias(c) for c, t in [
        ("driver_id", "string"), ("vehicle_type", "string"), ("city", "string"), ("event_date", "date"),
        ("ride_duration_min", "double"), ("distance_km", "double"), ("fare_amount", "double"),
        ("paid_amount", "double"), ("payment_method", "string")]])
    assert [r["ride_id"] for r in G.stg_rides(raw).collect()] == ["r1"]


@pytest.mark.parametrize("date", ["2024-01-02"])
def test_date_filter_prunes_partitions(spark, raw_frame, tmp_lake, date):
    paths = jobs.LakePaths(tmp_lake)
    b = _bronze(raw_frame, [ev("r1", "ride_requested", time=T.format(d=1, h=1, m=0)),
                            ev("r2", "ride_requested", time=T.format(d=2, h=1, m=0))])
    from triplake.sinks.lake import append_bronze
    append_bronze(b, paths.bronze)
    from triplake.sources.lake import read_bronze
    df = S.for_date(read_bronze(spark, paths.bronze), date)
    plan = plan_text(df)
    assert "PartitionFilters: [isnotnull(event_date" in plan and "2024-01-02" in plan
    assert [r["ride_id"] for r in df.collect()] == ["r2"]
