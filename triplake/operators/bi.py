"""BI measures over the Gold star schema: KPI row and breakdowns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triplake.functions import half_up_avg, half_up_sum
from triplake.functions.numeric import merged_sums, partial_sum, rounded_total


def kpis(fct_rides: DataFrame) -> DataFrame:
    """Total revenue and rides, average fare, revenue per ride, average
    rating of active drivers (each driver once), active drivers.

    Two aggregation levels instead of a join: per driver first (a hot
    driver is combined map-side), then one global row.
    """
    per_driver = fct_rides.groupBy("driver_id").agg(
        F.count(F.lit(1)).alias("rides"),
        partial_sum("revenue").alias("revenue"),
        partial_sum("fare_amount").alias("fare"),
        F.count("fare_amount").alias("fare_n"),
        F.max("driver_rating").alias("rating"),
    )
    revenue = merged_sums("revenue")
    return per_driver.agg(
        rounded_total(revenue).alias("total_revenue"),
        F.sum("rides").alias("total_rides"),
        rounded_total(merged_sums("fare"), F.sum("fare_n")).alias("avg_fare"),
        rounded_total(revenue, F.sum("rides"), first=2).alias("revenue_per_ride"),
        half_up_avg(F.when(F.col("driver_id").isNotNull(), F.col("rating")), 2).alias("avg_driver_rating"),
        F.count("driver_id").alias("active_drivers"),
    )


def revenue_by(fct_rides: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    """Rides and revenue per value of ``column`` (null is its own group)."""
    return fct_rides.groupBy(F.col(column).alias(alias or column)).agg(
        F.count(F.lit(1)).alias("rides"),
        half_up_sum("revenue", 2).alias("revenue"),
    )


def revenue_by_vehicle(fct_rides: DataFrame) -> DataFrame:
    return revenue_by(fct_rides, "vehicle_type")


def revenue_by_segment(fct_rides: DataFrame) -> DataFrame:
    return revenue_by(fct_rides, "rider_segment")


def demand_by_hour(fct_hourly: DataFrame) -> DataFrame:
    """Requests per hour of day over all cities/days, busiest hour flagged.

    The flag ranks the aggregated rows, at most 24 (one per hour of day),
    so the unpartitioned window sees a bounded input.
    """
    by_hour = fct_hourly.groupBy("hour_of_day").agg(
        F.sum("ride_requests").alias("ride_requests"),
        F.count_if(F.col("is_peak_hour")).alias("peak_city_days"),
    )
    rank = F.row_number().over(Window.orderBy(F.col("ride_requests").desc(), F.col("hour_of_day")))
    return by_hour.withColumn("is_peak_hour", rank == 1)


def driver_performance(fct_rides: DataFrame) -> DataFrame:
    """Per driver: rides, revenue, average fare, rating."""
    return fct_rides.groupBy("driver_id").agg(
        F.max("driver_name").alias("driver_name"),
        F.max("driver_rating").alias("driver_rating"),
        F.count(F.lit(1)).alias("rides"),
        half_up_sum("revenue", 2).alias("revenue"),
        half_up_avg("fare_amount", 2).alias("avg_fare"),
    )


__all__ = ["kpis", "revenue_by_vehicle", "revenue_by_segment", "demand_by_hour", "driver_performance"]
