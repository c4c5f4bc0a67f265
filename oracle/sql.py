"""DuckDB SQL computing every registered query straight from the driver's tables.

Shares no code with the Spark side: the lens is re-derived here from
``events`` with plain SQL, Bronze filtering is expressed on the lens rule
flags, and rounded measures use exact integer arithmetic on cents and
tenths of a minute (half-up), so no floating summation order is involved.
"""

from __future__ import annotations

# --------------------------------------------------------------------------- #
# Shared CTEs
# --------------------------------------------------------------------------- #
_RIDES = """
o_rides AS (
  SELECT
    e.event_id AS n,
    CAST(e.ts AS TIMESTAMP) AS requested_at,
    'ride_' || CAST(e.event_id AS VARCHAR) AS rid,
    'rider_' || CAST(CASE WHEN e.event_id % 97 = 0 THEN -1 ELSE e.user_id END AS VARCHAR) AS rider_id,
    'driver_' || CAST(e.event_id % 110 AS VARCHAR) AS driver_id,
    (['bike', 'go', 'go_plus', 'business'])[e.event_id % 4 + 1] AS vehicle_type,
    CASE WHEN e.event_id % 50 = 0 THEN NULL ELSE g.r_name END AS city_raw,
    50 + e.event_id % 401 AS dd,
    CAST(floor(abs(COALESCE(e.value, 0.0)) * 100) AS BIGINT) + 100 AS fare_cents,
    (['cash', 'card', 'wallet'])[e.event_id % 3 + 1] AS pay_method,
    (e.event_type = 'error' AND e.event_id % 5 < 2) AS cancelled,
    e.event_id % 40 = 7 AS f_null_id,
    e.event_id % 41 = 7 AS f_bad_time,
    e.event_id % 43 = 7 AS f_ping,
    e.event_id % 59 = 7 AS f_not_json
  FROM events e
  LEFT JOIN region g ON g.r_regionkey = e.user_id % 5
)"""

_EVENTS = """
o_events AS (
  SELECT *, requested_at + to_seconds(off_s) AS ev_at FROM (
    SELECT *, 'ride_requested' AS etype, 0 AS off_s FROM o_rides
    UNION ALL SELECT *, 'ride_cancelled', 2 FROM o_rides WHERE cancelled
    UNION ALL SELECT *, 'ride_accepted', 60 FROM o_rides WHERE NOT cancelled
    UNION ALL SELECT *, 'ride_started', 180 FROM o_rides WHERE NOT cancelled
    UNION ALL SELECT *, 'ride_ended', 180 + 6 * dd FROM o_rides WHERE NOT cancelled
    UNION ALL SELECT *, 'payment_completed', 240 + 6 * dd FROM o_rides
      WHERE NOT cancelled AND n % 13 <> 0
  ) x
)"""

_PARSED = """
o_parsed AS (
  SELECT
    n, etype, f_null_id, f_bad_time, f_ping, f_not_json, dd, fare_cents, ev_at,
    CASE WHEN f_not_json THEN NULL ELSE rid || '#' || etype END AS event_id,
    CASE WHEN f_not_json THEN NULL WHEN f_ping THEN 'ping' ELSE etype END AS event_type,
    CASE WHEN f_not_json THEN NULL WHEN f_bad_time THEN 'not-a-time'
         ELSE strftime(ev_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS event_time,
    CASE WHEN f_not_json OR f_null_id THEN NULL ELSE rid END AS ride_id,
    CASE WHEN f_not_json THEN NULL ELSE city_raw END AS city,
    CASE WHEN f_not_json THEN NULL ELSE rider_id END AS rider_id,
    CASE WHEN f_not_json THEN NULL ELSE driver_id END AS driver_id,
    CASE WHEN f_not_json THEN NULL ELSE vehicle_type END AS vehicle_type,
    CASE WHEN NOT f_not_json AND etype = 'ride_requested'
         THEN (24800 + n % 100) / 1000.0::DOUBLE END AS pickup_lat,
    CASE WHEN NOT f_not_json AND etype = 'ride_requested'
         THEN (67000 + n % 200) / 1000.0::DOUBLE END AS pickup_lon,
    CASE WHEN NOT f_not_json AND etype = 'ride_requested'
         THEN (24900 + n % 150) / 1000.0::DOUBLE END AS dropoff_lat,
    CASE WHEN NOT f_not_json AND etype = 'ride_requested'
         THEN (67100 + n % 250) / 1000.0::DOUBLE END AS dropoff_lon,
    CASE WHEN NOT f_not_json AND etype = 'ride_ended' THEN dd / 10.0::DOUBLE END AS duration_min,
    CASE WHEN NOT f_not_json AND etype = 'ride_ended' THEN dd / 20.0::DOUBLE END AS distance_km,
    CASE WHEN NOT f_not_json AND etype = 'ride_ended' THEN fare_cents / 100.0::DOUBLE END AS fare_amount,
    CASE WHEN NOT f_not_json AND etype = 'payment_completed'
         THEN fare_cents / 100.0::DOUBLE END AS amount,
    CASE WHEN NOT f_not_json AND etype IN ('ride_ended', 'payment_completed') THEN 'PKR' END AS currency,
    CASE WHEN NOT f_not_json AND etype = 'payment_completed' THEN pay_method END AS payment_method,
    CASE WHEN NOT f_not_json AND etype = 'payment_completed' THEN 'success' END AS status,
    CASE WHEN NOT f_not_json AND etype = 'ride_cancelled' THEN 'rider' END AS cancelled_by,
    CASE WHEN NOT f_not_json AND etype = 'ride_cancelled' THEN 'changed_plans' END AS reason,
    ev_at AS kafka_time
  FROM o_events
)"""

# Bronze: every planned fault drops the event; measures also kept as integers
_BRONZE = """
o_bronze AS (
  SELECT
    event_id, event_type, event_time, ride_id,
    COALESCE(city, 'AFRICA') AS city,
    rider_id, driver_id, vehicle_type, pickup_lat, pickup_lon, dropoff_lat, dropoff_lon,
    duration_min, distance_km, fare_amount, amount, currency, payment_method, status,
    cancelled_by, reason, kafka_time,
    ev_at AS event_timestamp,
    COALESCE(city, 'AFRICA') IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST') AS is_valid_city,
    CASE WHEN etype = 'ride_ended' THEN duration_min END AS ride_duration_min,
    'ride-events' AS source_topic,
    CAST(ev_at AS DATE) AS event_date,
    CASE WHEN etype = 'ride_ended' THEN dd END AS dd_tenths,
    CASE WHEN etype = 'payment_completed' THEN fare_cents END AS paid_cents,
    CASE WHEN etype = 'ride_ended' THEN fare_cents END AS fare_cents_ended
  FROM o_parsed
  WHERE NOT (f_null_id OR f_bad_time OR f_ping OR f_not_json)
)"""

_OVERLAY = """
o_bronze_edge AS (
  SELECT * FROM o_bronze
  WHERE NOT (
    (event_type = 'ride_ended' AND city = 'ASIA' AND event_date = DATE '2024-01-05')
    OR (event_type = 'payment_completed' AND city = 'MIDDLE EAST'
        AND event_date IN (DATE '2024-01-10', DATE '2024-01-20'))
  )
)"""


def _daily(name: str, source: str) -> str:
    """Daily city metrics from a Bronze CTE, with integer cents kept alongside."""
    return f"""
{name}_r AS (
  SELECT event_date, city, COUNT(DISTINCT ride_id) AS total_rides,
         SUM(dd_tenths) AS sum_tenths, COUNT(dd_tenths) AS n_dur
  FROM {source} WHERE event_type = 'ride_ended' GROUP BY event_date, city
),
{name}_p AS (
  SELECT event_date, city, SUM(paid_cents) AS rev_cents, COUNT(DISTINCT ride_id) AS paid_rides
  FROM {source} WHERE event_type = 'payment_completed' GROUP BY event_date, city
),
{name} AS (
  SELECT
    COALESCE(r.event_date, p.event_date) AS event_date,
    COALESCE(r.city, p.city) AS city,
    COALESCE(r.total_rides, 0) AS total_rides,
    COALESCE(CAST((20 * r.sum_tenths + r.n_dur) // (2 * r.n_dur) AS DOUBLE) / 100.0, 0.0)
      AS avg_duration_min,
    COALESCE(CAST(p.rev_cents AS DOUBLE) / 100.0, 0.0) AS revenue_pkr,
    COALESCE(p.paid_rides, 0) AS paid_rides,
    COALESCE(p.rev_cents, 0) AS rev_cents
  FROM {name}_r r FULL OUTER JOIN {name}_p p
    ON r.event_date = p.event_date AND r.city = p.city
)"""


_HOURLY = """
o_hourly_req AS (
  SELECT event_date, city, CAST(hour(event_timestamp) AS INTEGER) AS hour,
         COUNT(DISTINCT ride_id) AS ride_requests
  FROM o_bronze WHERE event_type = 'ride_requested' GROUP BY 1, 2, 3
),
o_hourly AS (
  SELECT *, row_number() OVER (PARTITION BY event_date, city
                               ORDER BY ride_requests DESC, hour ASC) = 1 AS is_peak_hour
  FROM o_hourly_req
)"""

_RAW = """
o_raw_rides AS (
  SELECT e.ride_id, e.rider_id, e.driver_id, e.vehicle_type, e.city, e.event_date,
         e.ride_duration_min, e.distance_km, e.fare_amount,
         p.amount AS paid_amount, p.payment_method,
         e.fare_cents_ended AS fare_cents, p.paid_cents
  FROM (SELECT * FROM o_bronze WHERE event_type = 'ride_ended') e
  LEFT JOIN (SELECT * FROM o_bronze WHERE event_type = 'payment_completed') p
    ON e.ride_id = p.ride_id
)"""

_DIMS = """
o_dim_driver AS (
  SELECT 'driver_' || CAST(s.s_suppkey AS VARCHAR) AS driver_id,
         s.s_name AS driver_name,
         (36 + s.s_suppkey % 15) / 10.0::DOUBLE AS rating,
         36 + s.s_suppkey % 15 AS rating_tenths,
         nt.n_name AS home_zone,
         (['bike', 'go', 'go_plus', 'business'])[s.s_suppkey % 4 + 1] AS primary_vehicle,
         DATE '2022-01-01' + CAST(s.s_suppkey % 1400 AS INTEGER) AS joined_date
  FROM supplier s LEFT JOIN nation nt ON s.s_nationkey = nt.n_nationkey
),
o_dim_rider AS (
  SELECT 'rider_' || CAST(c.c_custkey AS VARCHAR) AS rider_id,
         c.c_name AS rider_name,
         lower(c.c_mktsegment) AS segment,
         DATE '2022-01-01' + CAST(c.c_custkey % 1800 AS INTEGER) AS signup_date
  FROM customer c
)"""

_FCT = """
o_fct_rides AS (
  SELECT r.ride_id, r.event_date AS ride_date, r.city, lower(r.vehicle_type) AS vehicle_type,
         r.rider_id, ri.rider_name, ri.segment AS rider_segment,
         r.driver_id, d.driver_name, d.rating AS driver_rating, d.home_zone AS driver_home_zone,
         r.ride_duration_min AS duration_min, r.distance_km, r.fare_amount,
         COALESCE(r.paid_amount, r.fare_amount) AS revenue,
         r.payment_method,
         COALESCE(r.paid_cents, r.fare_cents) AS revenue_cents,
         r.fare_cents, d.rating_tenths
  FROM o_raw_rides r
  LEFT JOIN o_dim_driver d ON r.driver_id = d.driver_id
  LEFT JOIN o_dim_rider ri ON r.rider_id = ri.rider_id
  WHERE r.ride_id IS NOT NULL
),
o_fct_daily AS (
  SELECT event_date AS metric_date, city, total_rides, avg_duration_min, revenue_pkr, paid_rides,
         CASE WHEN total_rides > 0
              THEN CAST((2 * rev_cents + total_rides) // (2 * total_rides) AS DOUBLE) / 100.0
              ELSE 0.0 END AS revenue_per_ride
  FROM o_daily
),
o_fct_hourly AS (
  SELECT event_date AS demand_date, city, hour AS hour_of_day, ride_requests, is_peak_hour
  FROM o_hourly
)"""

WITH = "WITH " + ",".join([
    _RIDES, _EVENTS, _PARSED, _BRONZE, _OVERLAY,
    _daily("o_daily", "o_bronze"), _daily("o_daily_edge", "o_bronze_edge"),
    _HOURLY, _RAW, _DIMS, _FCT,
]) + "\n"

EVENT_COLS = """event_id, event_type, event_time, ride_id, city, rider_id, driver_id, vehicle_type,
  pickup_lat, pickup_lon, dropoff_lat, dropoff_lon, duration_min, distance_km, fare_amount, amount,
  currency, payment_method, status, cancelled_by, reason"""

BRONZE_ROWS = f"""SELECT {EVENT_COLS}, kafka_time, event_timestamp, is_valid_city, ride_duration_min,
  source_topic, event_date FROM o_bronze"""

DAILY_COLS = "event_date, city, total_rides, avg_duration_min, revenue_pkr, paid_rides"

LENS_CITIES = "('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST')"
STRICT_CITIES = "('AFRICA', 'AMERICA', 'ASIA', 'EUROPE')"


def _suite_bronze(source: str, cities: str) -> str:
    return f"""
SELECT 'bronze_rides' AS layer, c.check_no, c."check", c."column", c.unexpected_count,
       c.unexpected_count = 0 AS passed
FROM (
  SELECT 1 AS check_no, 'expect_column_values_to_not_be_null' AS "check", 'ride_id' AS "column",
         count_if(ride_id IS NULL) AS unexpected_count FROM {source} WHERE event_type = 'ride_ended'
  UNION ALL
  SELECT 2, 'expect_column_values_to_be_between', 'ride_duration_min',
         count_if(ride_duration_min < 0) FROM {source} WHERE event_type = 'ride_ended'
  UNION ALL
  SELECT 3, 'expect_column_values_to_be_in_set', 'city',
         count_if(city NOT IN {cities}) FROM {source} WHERE event_type = 'ride_ended'
  UNION ALL
  SELECT 4, 'expect_column_values_to_be_between', 'fare_amount',
         count_if(fare_amount <= 0) FROM {source} WHERE event_type = 'ride_ended'
) c"""


def _suite_silver(source: str, cities: str) -> str:
    return f"""
SELECT 'silver_daily_city_metrics' AS layer, c.check_no, c."check", c."column",
       c.unexpected_count, c.unexpected_count = 0 AS passed
FROM (
  SELECT 1 AS check_no, 'expect_column_values_to_not_be_null' AS "check", 'city' AS "column",
         count_if(city IS NULL) AS unexpected_count FROM {source}
  UNION ALL SELECT 2, 'expect_column_values_to_be_in_set', 'city', count_if(city NOT IN {cities}) FROM {source}
  UNION ALL SELECT 3, 'expect_column_values_to_be_between', 'revenue_pkr', count_if(revenue_pkr <= 0) FROM {source}
  UNION ALL SELECT 4, 'expect_column_values_to_be_between', 'total_rides', count_if(total_rides < 0) FROM {source}
  UNION ALL SELECT 5, 'expect_column_values_to_be_between', 'avg_duration_min',
                   count_if(avg_duration_min < 0) FROM {source}
) c"""


def _summary(scenario: str, report: str) -> str:
    return f"""
SELECT '{scenario}' AS scenario, layer, COUNT(*) AS checks, count_if(NOT passed) AS failed,
       bool_and(passed) AS passed
FROM ({report}) rep GROUP BY layer"""


def _test(model: str, column: str, test: str, failures_sql: str) -> str:
    return f"""
SELECT '{model}' AS model, '{column}' AS column_name, '{test}' AS test, f.failures,
       CASE WHEN f.failures = 0 THEN 'pass' ELSE 'fail' END AS status
FROM ({failures_sql}) f"""


def _unique(model_cte: str, model: str, col: str) -> str:
    return _test(model, col, "unique", f"""
  SELECT COUNT(*) AS failures FROM (
    SELECT {col} FROM {model_cte} WHERE {col} IS NOT NULL GROUP BY {col} HAVING COUNT(*) > 1) u""")


def _not_null(model_cte: str, model: str, col: str) -> str:
    return _test(model, col, "not_null", f"SELECT count_if({col} IS NULL) AS failures FROM {model_cte}")


TESTS_UNIQUE = " UNION ALL ".join([
    _unique("o_dim_driver", "dim_driver", "driver_id"),
    _unique("o_dim_rider", "dim_rider", "rider_id"),
    _unique("o_fct_rides", "fct_rides", "ride_id"),
])
TESTS_NOT_NULL = " UNION ALL ".join([
    _not_null("o_dim_driver", "dim_driver", "driver_id"),
    _not_null("o_dim_rider", "dim_rider", "rider_id"),
    _not_null("o_fct_rides", "fct_rides", "ride_id"),
    _not_null("o_fct_rides", "fct_rides", "city"),
    _not_null("o_fct_rides", "fct_rides", "revenue"),
    _not_null("o_fct_daily", "fct_daily_city_metrics", "metric_date"),
    _not_null("o_fct_daily", "fct_daily_city_metrics", "total_rides"),
    _not_null("o_fct_hourly", "fct_hourly_demand", "demand_date"),
    _not_null("o_fct_hourly", "fct_hourly_demand", "hour_of_day"),
])
TEST_ACCEPTED = _test("fct_rides", "city", "accepted_values", f"""
  SELECT COUNT(DISTINCT city) AS failures FROM o_fct_rides
  WHERE city IS NOT NULL AND city NOT IN {LENS_CITIES}""")
TEST_RELATIONSHIPS = _test("fct_rides", "driver_id", "relationships", """
  SELECT COUNT(*) AS failures FROM o_fct_rides f
  WHERE f.driver_id IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM o_dim_driver d WHERE d.driver_id = f.driver_id)""")


def _counts(parts: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, COUNT(*) AS row_count FROM {src}"
        for layer, name, src in parts
    )


def _lake_counts(daily: str, hourly: str) -> list[tuple[str, str, str]]:
    return [
        ("raw", "rides", "o_raw_rides"),
        ("raw", "silver_daily_city_metrics", daily),
        ("raw", "silver_hourly_demand", hourly),
        ("gold", "dim_driver", "o_dim_driver"),
        ("gold", "dim_rider", "o_dim_rider"),
        ("gold", "fct_rides", "o_fct_rides"),
        ("gold", "fct_daily_city_metrics", daily),
        ("gold", "fct_hourly_demand", hourly),
    ]


PIPELINE_DAY = "DATE '2024-01-15'"
ALL_DRIVERS = """(SELECT driver_id FROM o_dim_driver UNION
    SELECT driver_id FROM o_bronze WHERE driver_id IS NOT NULL)"""

_Q = {
    # ---------------------------------------------------------------- Bronze
    "bronze_parse": f"SELECT {EVENT_COLS}, kafka_time FROM o_parsed",
    "bronze_clean": "SELECT event_id, event_type, ride_id, event_time, event_timestamp, event_date FROM o_bronze",
    "bronze_city_tag": "SELECT event_id, event_type, city, is_valid_city FROM o_bronze",
    "bronze_duration": "SELECT event_id, event_type, duration_min, ride_duration_min FROM o_bronze",
    "bronze_metadata": """SELECT source_topic, COUNT(*) AS "rows", COUNT(*) AS rows_with_ingest_time
                          FROM o_bronze GROUP BY source_topic""",
    "bronze_roundtrip": BRONZE_ROWS,
    "bronze_event_counts": 'SELECT event_type, COUNT(*) AS "count" FROM o_bronze GROUP BY event_type ORDER BY event_type',
    "bronze_slice_by_type": """SELECT event_type, COUNT(*) AS "rows", COUNT(DISTINCT ride_id) AS rides
        FROM o_bronze WHERE event_type IN ('ride_ended', 'ride_requested', 'payment_completed')
        GROUP BY event_type""",
    "bronze_stream_land": BRONZE_ROWS,
    "bronze_stream_resume": """SELECT event_type, COUNT(*) AS "rows", COUNT(DISTINCT event_id) AS distinct_events
        FROM o_bronze GROUP BY event_type""",
    "bronze_batch_summary": "SELECT event_type, COUNT(*) AS landed, COUNT(*) AS summarised FROM o_bronze GROUP BY event_type",
    # ---------------------------------------------------------------- Silver
    "silver_ride_counts": "SELECT event_date, city, total_rides, avg_duration_min FROM o_daily WHERE total_rides > 0",
    "silver_revenue": "SELECT event_date, city, revenue_pkr, paid_rides FROM o_daily WHERE paid_rides > 0",
    "silver_daily_city_metrics": f"SELECT {DAILY_COLS} FROM o_daily ORDER BY event_date, city",
    "silver_hourly_requests": "SELECT event_date, city, hour, ride_requests FROM o_hourly_req",
    "silver_hourly_demand": "SELECT event_date, city, hour, ride_requests, is_peak_hour FROM o_hourly ORDER BY 1, 2, 3",
    "silver_peak_hour": "SELECT event_date, city, hour, ride_requests, is_peak_hour FROM o_hourly WHERE is_peak_hour",
    "silver_daily_one_day": f"""SELECT {DAILY_COLS} FROM o_daily WHERE event_date = DATE '2024-01-05'
                                ORDER BY event_date, city""",
    "silver_overwrite_one_day": f"""
        SELECT {DAILY_COLS} FROM o_daily WHERE event_date <> DATE '2024-01-10'
        UNION ALL SELECT {DAILY_COLS} FROM o_daily_edge WHERE event_date = DATE '2024-01-10'""",
    "silver_empty_day_noop": f"SELECT {DAILY_COLS} FROM o_daily",
    # ---------------------------------------------------------------- RAW
    "raw_rides": """SELECT ride_id, rider_id, driver_id, vehicle_type, city, event_date, ride_duration_min,
                           distance_km, fare_amount, paid_amount, payment_method FROM o_raw_rides""",
    "raw_upper_columns": """SELECT ride_id AS "RIDE_ID", rider_id AS "RIDER_ID", driver_id AS "DRIVER_ID",
        vehicle_type AS "VEHICLE_TYPE", city AS "CITY", event_date AS "EVENT_DATE",
        ride_duration_min AS "RIDE_DURATION_MIN", distance_km AS "DISTANCE_KM", fare_amount AS "FARE_AMOUNT",
        paid_amount AS "PAID_AMOUNT", payment_method AS "PAYMENT_METHOD" FROM o_raw_rides""",
    "raw_daily_load": """SELECT city AS "CITY", total_rides AS "TOTAL_RIDES", avg_duration_min AS "AVG_DURATION_MIN",
        revenue_pkr AS "REVENUE_PKR", paid_rides AS "PAID_RIDES", event_date AS "EVENT_DATE" FROM o_daily""",
    "raw_hourly_load": """SELECT city AS "CITY", hour AS "HOUR", ride_requests AS "RIDE_REQUESTS",
        is_peak_hour AS "IS_PEAK_HOUR", event_date AS "EVENT_DATE" FROM o_hourly""",
    # ---------------------------------------------------------------- Gold
    "seed_load": "SELECT driver_id, driver_name, rating, home_zone, primary_vehicle, joined_date FROM o_dim_driver",
    "seed_load_riders": "SELECT rider_id, rider_name, segment, signup_date FROM o_dim_rider",
    "stg_rides": """SELECT ride_id, rider_id, driver_id, lower(vehicle_type) AS vehicle_type, city,
        event_date AS ride_date, ride_duration_min AS duration_min, distance_km, fare_amount, paid_amount,
        payment_method FROM o_raw_rides WHERE ride_id IS NOT NULL""",
    "stg_daily_city_metrics": """SELECT event_date AS metric_date, city, total_rides, avg_duration_min,
        revenue_pkr, paid_rides FROM o_daily""",
    "stg_hourly_demand": """SELECT event_date AS demand_date, city, hour AS hour_of_day, ride_requests,
        is_peak_hour FROM o_hourly""",
    "dim_driver": "SELECT driver_id, driver_name, rating, home_zone, primary_vehicle, joined_date FROM o_dim_driver",
    "dim_rider": "SELECT rider_id, rider_name, segment, signup_date FROM o_dim_rider",
    "fct_rides": """SELECT ride_id, ride_date, city, vehicle_type, rider_id, rider_name, rider_segment,
        driver_id, driver_name, driver_rating, driver_home_zone, duration_min, distance_km, fare_amount,
        revenue, payment_method FROM o_fct_rides""",
    "fct_daily_city_metrics": """SELECT metric_date, city, total_rides, avg_duration_min, revenue_pkr,
        paid_rides, revenue_per_ride FROM o_fct_daily""",
    "fct_hourly_demand": "SELECT demand_date, city, hour_of_day, ride_requests, is_peak_hour FROM o_fct_hourly",
    "test_unique": TESTS_UNIQUE,
    "test_not_null": TESTS_NOT_NULL,
    "test_accepted_values": TEST_ACCEPTED,
    "test_fct_rides_relationships": TEST_RELATIONSHIPS,
    # ---------------------------------------------------------------- quality gate
    "dq_bronze": _suite_bronze("o_bronze", LENS_CITIES),
    "dq_silver": _suite_silver("o_daily", LENS_CITIES),
    "dq_report": _suite_bronze("o_bronze", STRICT_CITIES) + " UNION ALL "
                 + _suite_silver("o_daily", STRICT_CITIES),
    "dq_gate_verdict": _summary("base", _suite_bronze("o_bronze", LENS_CITIES) + " UNION ALL "
                                + _suite_silver("o_daily", LENS_CITIES))
                       + " UNION ALL "
                       + _summary("edge", _suite_bronze("o_bronze", STRICT_CITIES) + " UNION ALL "
                                  + _suite_silver("o_daily", STRICT_CITIES)),
    # ---------------------------------------------------------------- verification and BI
    "verify_row_counts": _counts(_lake_counts("o_daily", "o_hourly")),
    "verify_orphans": """SELECT count_if(driver_name IS NULL) AS orphan_drivers,
        count_if(rider_name IS NULL) AS orphan_riders, COUNT(*) AS total_rides FROM o_fct_rides""",
    "verify_preview": """SELECT ride_id, ride_date, vehicle_type, rider_segment, driver_rating, fare_amount,
        revenue, payment_method FROM o_fct_rides ORDER BY ride_id LIMIT 5""",
    "bi_kpis": """
        SELECT CAST(SUM(revenue_cents) AS DOUBLE) / 100.0 AS total_revenue,
               COUNT(*) AS total_rides,
               CAST((2 * SUM(fare_cents) + COUNT(fare_cents)) // (2 * COUNT(fare_cents)) AS DOUBLE) / 100.0
                 AS avg_fare,
               CAST((2 * SUM(revenue_cents) + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 100.0 AS revenue_per_ride,
               (SELECT CAST((20 * SUM(t) + COUNT(t)) // (2 * COUNT(t)) AS DOUBLE) / 100.0
                  FROM (SELECT MAX(rating_tenths) AS t FROM o_fct_rides
                        WHERE driver_id IS NOT NULL GROUP BY driver_id) dr) AS avg_driver_rating,
               COUNT(DISTINCT driver_id) AS active_drivers
        FROM o_fct_rides""",
    "bi_revenue_by_vehicle": """SELECT vehicle_type, COUNT(*) AS rides,
        CAST(SUM(revenue_cents) AS DOUBLE) / 100.0 AS revenue FROM o_fct_rides GROUP BY vehicle_type""",
    "bi_revenue_by_segment": """SELECT rider_segment, COUNT(*) AS rides,
        CAST(SUM(revenue_cents) AS DOUBLE) / 100.0 AS revenue FROM o_fct_rides GROUP BY rider_segment""",
    "bi_demand_by_hour": """
        SELECT hour_of_day, ride_requests, peak_city_days,
               row_number() OVER (ORDER BY ride_requests DESC, hour_of_day) = 1 AS is_peak_hour
        FROM (SELECT hour_of_day, CAST(SUM(ride_requests) AS BIGINT) AS ride_requests,
                     count_if(is_peak_hour) AS peak_city_days
              FROM o_fct_hourly GROUP BY hour_of_day) h""",
    "bi_driver_performance": """
        SELECT driver_id, MAX(driver_name) AS driver_name, MAX(driver_rating) AS driver_rating,
               COUNT(*) AS rides, CAST(SUM(revenue_cents) AS DOUBLE) / 100.0 AS revenue,
               CAST((2 * SUM(fare_cents) + COUNT(fare_cents)) // (2 * COUNT(fare_cents)) AS DOUBLE) / 100.0
                 AS avg_fare
        FROM o_fct_rides GROUP BY driver_id""",
    # ---------------------------------------------------------------- pipeline
    "pipeline_daily": _counts(
        [("silver", "daily_city_metrics", f"(SELECT * FROM o_daily WHERE event_date = {PIPELINE_DAY})"),
         ("silver", "hourly_demand", f"(SELECT * FROM o_hourly WHERE event_date = {PIPELINE_DAY})")]
        + _lake_counts(f"(SELECT * FROM o_daily WHERE event_date = {PIPELINE_DAY})",
                       f"(SELECT * FROM o_hourly WHERE event_date = {PIPELINE_DAY})")),
    "pipeline_backfill": _counts(
        [("silver", "daily_city_metrics", "o_daily"), ("silver", "hourly_demand", "o_hourly")]
        + _lake_counts("o_daily", "o_hourly")),
    "pipeline_strict": _counts(
        [("silver", "daily_city_metrics", "o_daily"), ("silver", "hourly_demand", "o_hourly")]
        + [(layer, name, ALL_DRIVERS if name == "dim_driver" else sql)
           for layer, name, sql in _lake_counts("o_daily", "o_hourly")]),
}

def _bigint_count_if(sql: str) -> str:
    """``count_if(x)`` -> ``CAST(count_if(x) AS BIGINT)`` (DuckDB returns HUGEINT)."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j] + "CAST(" + sql[j:k] + " AS BIGINT)")
        i = k


ORACLE_SQL: dict[str, str] = {k: _bigint_count_if(WITH + v) for k, v in _Q.items()}

# the same table by its catalog name
ORACLE_SQL["raw_rides_by_name"] = ORACLE_SQL["raw_upper_columns"]
