"""Schemas of the event contract and of each lake layer."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

POINT = StructType([
    StructField("lat", DoubleType()),
    StructField("lon", DoubleType()),
])

# Fixed values (the event contract): names, order and types of the JSON fields.
EVENT_SCHEMA = StructType([
    StructField("event_id", StringType()),
    StructField("event_type", StringType()),
    StructField("event_time", StringType()),
    StructField("ride_id", StringType()),
    StructField("city", StringType()),
    StructField("rider_id", StringType()),
    StructField("driver_id", StringType()),
    StructField("vehicle_type", StringType()),
    StructField("pickup", POINT),
    StructField("dropoff", POINT),
    StructField("duration_min", DoubleType()),
    StructField("distance_km", DoubleType()),
    StructField("fare_amount", DoubleType()),
    StructField("amount", DoubleType()),
    StructField("currency", StringType()),
    StructField("payment_method", StringType()),
    StructField("status", StringType()),
    StructField("cancelled_by", StringType()),
    StructField("reason", StringType()),
])

# What a message bus delivers (the columns the Bronze transform uses).
ENVELOPE_SCHEMA = StructType([
    StructField("key", StringType()),
    StructField("value", StringType()),
    StructField("timestamp", TimestampType()),
])

BRONZE_PARTITIONS = ("event_date", "event_type")
SILVER_PARTITIONS = ("event_date",)

DAILY_CITY_METRICS_SCHEMA = StructType([
    StructField("event_date", DateType()),
    StructField("city", StringType()),
    StructField("total_rides", LongType()),
    StructField("avg_duration_min", DoubleType()),
    StructField("revenue_pkr", DoubleType()),
    StructField("paid_rides", LongType()),
])

HOURLY_DEMAND_SCHEMA = StructType([
    StructField("event_date", DateType()),
    StructField("city", StringType()),
    StructField("hour", IntegerType()),
    StructField("ride_requests", LongType()),
    StructField("is_peak_hour", BooleanType()),
])

SEED_DRIVERS_SCHEMA = StructType([
    StructField("driver_id", StringType()),
    StructField("driver_name", StringType()),
    StructField("rating", DoubleType()),
    StructField("home_zone", StringType()),
    StructField("primary_vehicle", StringType()),
    StructField("joined_date", DateType()),
])

SEED_RIDERS_SCHEMA = StructType([
    StructField("rider_id", StringType()),
    StructField("rider_name", StringType()),
    StructField("segment", StringType()),
    StructField("signup_date", DateType()),
])
