"""Gold: staging views, dimensions and facts (a star schema)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplake.functions import half_up_ratio


# -- staging ---------------------------------------------------------------- #
# Output columns of the staging models, as expressions over the RAW tables; the views in the catalog are made of the same.
STG_RIDES = ["ride_id", "rider_id", "driver_id", "lower(vehicle_type) AS vehicle_type", "city",
             "cast(event_date AS date) AS ride_date", "cast(ride_duration_min AS double) AS duration_min",
             "cast(distance_km AS double) AS distance_km", "cast(fare_amount AS double) AS fare_amount",
             "cast(paid_amount AS double) AS paid_amount", "payment_method"]
STG_RIDES_ROWS = "ride_id IS NOT NULL"
STG_DAILY = ["cast(event_date AS date) AS metric_date", "city", "cast(total_rides AS bigint) AS total_rides",
             "cast(avg_duration_min AS double) AS avg_duration_min", "cast(revenue_pkr AS double) AS revenue_pkr",
             "cast(paid_rides AS bigint) AS paid_rides"]
STG_HOURLY = ["cast(event_date AS date) AS demand_date", "city", "cast(hour AS int) AS hour_of_day",
              "cast(ride_requests AS bigint) AS ride_requests", "cast(is_peak_hour AS boolean) AS is_peak_hour"]


def stg_rides(raw_rides: DataFrame) -> DataFrame:
    return raw_rides.where(STG_RIDES_ROWS).selectExpr(*STG_RIDES)


def stg_daily_city_metrics(raw_daily: DataFrame) -> DataFrame:
    return raw_daily.selectExpr(*STG_DAILY)


def stg_hourly_demand(raw_hourly: DataFrame) -> DataFrame:
    return raw_hourly.selectExpr(*STG_HOURLY)


# -- dimensions ------------------------------------------------------------- #
def dim_driver(seed: DataFrame) -> DataFrame:
    return seed.select(
        "driver_id",
        "driver_name",
        F.col("rating").cast("double").alias("rating"),
        "home_zone",
        "primary_vehicle",
        F.col("joined_date").cast("date").alias("joined_date"),
    )


def dim_rider(seed: DataFrame) -> DataFrame:
    return seed.select(
        "rider_id",
        "rider_name",
        "segment",
        F.col("signup_date").cast("date").alias("signup_date"),
    )


# -- facts ------------------------------------------------------------------ #
def fct_daily_city_metrics(stg: DataFrame) -> DataFrame:
    return stg.select(
        "metric_date",
        "city",
        "total_rides",
        "avg_duration_min",
        "revenue_pkr",
        "paid_rides",
        F.when(F.col("total_rides") > 0, half_up_ratio("revenue_pkr", "total_rides", 2))
        .otherwise(F.lit(0.0))
        .alias("revenue_per_ride"),
    )


def fct_hourly_demand(stg: DataFrame) -> DataFrame:
    return stg.select("demand_date", "city", "hour_of_day", "ride_requests", "is_peak_hour")


def fct_rides(stg: DataFrame, drivers: DataFrame, riders: DataFrame) -> DataFrame:
    """Rides left-joined to both dimensions.

    No broadcast hint: the optimizer and AQE broadcast a dimension whose
    measured bytes are below the session's threshold and shuffle it otherwise.
    """
    d = drivers.select(
        "driver_id", "driver_name", F.col("rating").alias("driver_rating"),
        F.col("home_zone").alias("driver_home_zone"),
    )
    ri = riders.select(
        "rider_id", "rider_name", F.col("segment").alias("rider_segment"),
    )
    return (
        stg.join(d, "driver_id", "left")
        .join(ri, "rider_id", "left")
        .select(
            "ride_id", "ride_date", "city", "vehicle_type",
            "rider_id", "rider_name", "rider_segment",
            "driver_id", "driver_name", "driver_rating", "driver_home_zone",
            "duration_min", "distance_km", "fare_amount",
            F.coalesce(F.col("paid_amount"), F.col("fare_amount")).alias("revenue"),
            "payment_method",
        )
    )
