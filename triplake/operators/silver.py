"""Silver: daily city metrics and hourly demand with the peak hour flagged.

Shuffle shape: every distinct count on ``ride_id`` is planned by Catalyst as
a partial aggregate keyed by (group keys, ride_id), so the wide exchange is
spread by ride and a city holding a third of all rides still spreads over
all tasks; the second exchange carries one row per group per task. The
daily join runs on two tiny aggregates keyed by (date, city).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triplake.functions import half_up_avg, half_up_sum
from triplake.operators.bronze import slice_type

DAY_KEYS = ("event_date", "city")
HOUR_KEYS = ("event_date", "city", "hour")


def ride_counts(bronze: DataFrame) -> DataFrame:
    """Ended rides per city/day: distinct rides and average duration."""
    return slice_type(bronze, "ride_ended").groupBy(*DAY_KEYS).agg(
        F.count_distinct("ride_id").alias("total_rides"),
        half_up_avg("ride_duration_min", 2).alias("avg_duration_min"),
    )


def revenue(bronze: DataFrame) -> DataFrame:
    """Payments per city/day (dated by the payment event)."""
    return slice_type(bronze, "payment_completed").groupBy(*DAY_KEYS).agg(
        half_up_sum("amount", 2).alias("revenue_pkr"),
        F.count_distinct("ride_id").alias("paid_rides"),
    )


def daily_city_metrics(bronze: DataFrame, sort: bool = False) -> DataFrame:
    """Full outer join of rides and revenue; missing measures become 0."""
    out = (
        ride_counts(bronze)
        .join(revenue(bronze), list(DAY_KEYS), "full_outer")
        .na.fill(0)
        .select("event_date", "city", "total_rides", "avg_duration_min", "revenue_pkr", "paid_rides")
    )
    return out.orderBy(*DAY_KEYS) if sort else out


def hourly_requests(bronze: DataFrame) -> DataFrame:
    """Distinct ride requests per city/day/hour."""
    return (
        slice_type(bronze, "ride_requested")
        .withColumn("hour", F.hour(F.col("event_timestamp")))
        .groupBy(*HOUR_KEYS)
        .agg(F.count_distinct("ride_id").alias("ride_requests"))
    )


def _peak_rank():
    # ties on the request count go to the earliest hour
    return F.row_number().over(
        Window.partitionBy(*DAY_KEYS).orderBy(F.col("ride_requests").desc(), F.col("hour").asc())
    )


def hourly_demand(bronze: DataFrame, sort: bool = False) -> DataFrame:
    """Hourly requests with exactly one peak hour flagged per city/day."""
    out = hourly_requests(bronze).withColumn("is_peak_hour", _peak_rank() == 1)
    return out.orderBy(*HOUR_KEYS) if sort else out


def peak_hours(bronze: DataFrame) -> DataFrame:
    """Only the peak row per city/day (a rank filter Spark plans as a group limit)."""
    return (
        hourly_requests(bronze)
        .withColumn("rn", _peak_rank())
        .filter(F.col("rn") == 1)
        .select(*HOUR_KEYS, "ride_requests", F.lit(True).alias("is_peak_hour"))
    )


def check_date(date: str) -> str:
    """``YYYY-MM-DD`` or ValueError (checked here: under ANSI a bad literal
    would only fail inside a running job)."""
    import datetime as dt

    return dt.date.fromisoformat(str(date)).isoformat()


def for_date(bronze: DataFrame, date: str | None) -> DataFrame:
    """Restrict to one date (a partition filter on a landed table); None = all."""
    if date is None:
        return bronze
    return bronze.filter(F.col("event_date") == F.lit(check_date(date)).cast("date"))
