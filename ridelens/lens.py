"""Test input: trip events and dimensions derived from the driver's tables.

One ``events`` row is one requested ride (``n = event_id``). The lens emits
that ride's lifecycle as bus messages ``(key, value, timestamp)`` whose
``value`` is event JSON, so Bronze runs through the real parser. Rows are
expanded with a generator (``explode`` of a per-ride array), never a join,
so the work is a narrow map over ``events`` that grows linearly with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.config import LakeConfig

# --------------------------------------------------------------------------- #
# Fixed values of the lens (test-input definition).
# Vehicle types are picked by n % 4, payment method by n % 3; region names are
# the cities, AFRICA is the default city. A ride's fare is its event's value
# plus MIN_FARE_CENTS.
# --------------------------------------------------------------------------- #
VEHICLES = ("bike", "go", "go_plus", "business")
MIN_FARE_CENTS = 100
PAYMENT_METHODS = ("cash", "card", "wallet")
LENS_DEFAULT_CITY = "AFRICA"
LENS_VALID_CITIES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
LENS_CURRENCY = "PKR"
LENS_PAYMENT_STATUS = "success"
LENS_CANCELLED_BY = "rider"
LENS_CANCEL_REASON = "changed_plans"
# event type, seconds after the request (+ 6 s per tenth-minute of duration)
LIFECYCLE = (
    ("ride_requested", 0, 0),
    ("ride_cancelled", 2, 0),
    ("ride_accepted", 60, 0),
    ("ride_started", 180, 0),
    ("ride_ended", 180, 6),
    ("payment_completed", 240, 6),
)
# Planned faults, applied to every event of a ride: n % m == 7.
FAULT_NULL_RIDE_ID = 40
FAULT_BAD_TIME = 41
FAULT_UNKNOWN_TYPE = 43
FAULT_NOT_JSON = 59
# Edge overlay: one-sided rows for the daily outer join.
OVERLAY_DROP_ENDED = (("ASIA", "2024-01-05"),)
OVERLAY_DROP_PAID = (("MIDDLE EAST", "2024-01-10"), ("MIDDLE EAST", "2024-01-20"))

LENS_CONFIG = LakeConfig(default_city=LENS_DEFAULT_CITY, valid_cities=LENS_VALID_CITIES)
# The gate is made to fail by leaving MIDDLE EAST out of the valid set.
LENS_STRICT_CONFIG = LakeConfig(
    default_city=LENS_DEFAULT_CITY,
    valid_cities=tuple(c for c in LENS_VALID_CITIES if c != "MIDDLE EAST"),
)

TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
# Events (rides) a task expands: about five messages each.
ROWS_PER_TASK = 200_000


def _pick(values, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _str(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def parallelism(spark: SparkSession) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - remote session
        return int(spark.conf.get("spark.sql.shuffle.partitions", "8"))


def spread(df: DataFrame, *keys: str, least: int = 1) -> DataFrame:
    """Hash-spread ``df`` over the session's parallelism, ``least`` tasks or
    one per ``ROWS_PER_TASK`` rows, whichever is more. A scan's splits do not
    do that: they are cut by bytes, and all but the one that holds a row
    group's middle are empty. The rows are counted from the file footers."""
    tasks = max(parallelism(df.sparkSession), least, -(-df.count() // ROWS_PER_TASK))
    return df.repartition(tasks, *keys)


def rides(events: DataFrame, region: DataFrame, least_tasks: int = 1) -> DataFrame:
    """One row per ride with every attribute the lifecycle events carry."""
    reg = region.select("r_regionkey", "r_name")
    events = spread(events.select("event_id", "ts", "user_id", "event_type", "value"), "event_id", "ts", least=least_tasks)
    n = F.col("event_id")
    dd = F.lit(50) + n % 401  # duration in tenths of a minute
    cancelled = (F.col("event_type") == "error") & (n % 5 < 2)
    return (
        events.join(reg, (F.col("user_id") % 5) == F.col("r_regionkey"), "left")
        .select(
            n.alias("n"),
            F.col("ts").cast("timestamp").alias("requested_at"),
            _str("ride_", n).alias("ride_id"),
            _str("rider_", F.when(n % 97 == 0, F.lit(-1)).otherwise(F.col("user_id"))).alias("rider_id"),
            _str("driver_", n % 110).alias("driver_id"),
            _pick(VEHICLES, n % 4).alias("vehicle_type"),
            F.when(n % 50 == 0, F.lit(None).cast("string")).otherwise(F.col("r_name")).alias("city"),
            dd.alias("dd"),
            (dd / F.lit(10.0)).alias("duration_min"),
            (dd / F.lit(20.0)).alias("distance_km"),
            ((F.floor(F.abs(F.coalesce("value", F.lit(0.0))) * 100) + MIN_FARE_CENTS) / F.lit(100.0)).alias("fare"),
            _pick(PAYMENT_METHODS, n % 3).alias("payment_method"),
            cancelled.alias("cancelled"),
            (~cancelled & (n % 13 != 0)).alias("paid"),
        )
    )


def _lifecycle(r: DataFrame) -> DataFrame:
    emit = {
        "ride_requested": F.lit(True),
        "ride_cancelled": F.col("cancelled"),
        "ride_accepted": ~F.col("cancelled"),
        "ride_started": ~F.col("cancelled"),
        "ride_ended": ~F.col("cancelled"),
        "payment_completed": F.col("paid"),
    }
    steps = F.array(*[
        F.struct(
            F.lit(t).alias("etype"),
            (F.lit(base) + F.lit(per_dd) * F.col("dd")).alias("offset_s"),
            emit[t].alias("emit"),
        )
        for t, base, per_dd in LIFECYCLE
    ])
    return (
        r.select("*", F.explode(steps).alias("step"))
        .filter(F.col("step.emit"))
        .select(
            "*",
            F.col("step.etype").alias("etype"),
            F.timestamp_micros(
                F.unix_micros(F.col("requested_at")) + F.col("step.offset_s") * 1_000_000
            ).alias("at"),
        )
        .drop("step")
    )


def event_fields(r: DataFrame) -> DataFrame:
    """Lifecycle events with their (fault-injected) JSON fields as columns."""
    ev = _lifecycle(r)
    n, t = F.col("n"), F.col("etype")

    def only(kind, c):
        kinds = (kind,) if isinstance(kind, str) else kind
        return F.when(t.isin(*kinds), c)

    point = lambda lat0, lat_m, lon0, lon_m: F.struct(
        ((F.lit(lat0) + n % lat_m) / F.lit(1000.0)).alias("lat"),
        ((F.lit(lon0) + n % lon_m) / F.lit(1000.0)).alias("lon"),
    )
    return ev.select(
        "n",
        "at",
        F.concat(F.col("ride_id"), F.lit("#"), t).alias("event_id"),
        F.when(n % FAULT_UNKNOWN_TYPE == 7, F.lit("ping")).otherwise(t).alias("event_type"),
        F.when(n % FAULT_BAD_TIME == 7, F.lit("not-a-time"))
        .otherwise(F.date_format(F.col("at"), TIME_FORMAT)).alias("event_time"),
        F.when(n % FAULT_NULL_RIDE_ID == 7, F.lit(None).cast("string"))
        .otherwise(F.col("ride_id")).alias("ride_id"),
        "city",
        "rider_id",
        "driver_id",
        "vehicle_type",
        only("ride_requested", point(24800, 100, 67000, 200)).alias("pickup"),
        only("ride_requested", point(24900, 150, 67100, 250)).alias("dropoff"),
        only("ride_ended", F.col("duration_min")).alias("duration_min"),
        only("ride_ended", F.col("distance_km")).alias("distance_km"),
        only("ride_ended", F.col("fare")).alias("fare_amount"),
        only("payment_completed", F.col("fare")).alias("amount"),
        only(("ride_ended", "payment_completed"), F.lit(LENS_CURRENCY)).alias("currency"),
        only("payment_completed", F.col("payment_method")).alias("payment_method"),
        only("payment_completed", F.lit(LENS_PAYMENT_STATUS)).alias("status"),
        only("ride_cancelled", F.lit(LENS_CANCELLED_BY)).alias("cancelled_by"),
        only("ride_cancelled", F.lit(LENS_CANCEL_REASON)).alias("reason"),
    )


JSON_FIELDS = (
    "event_id", "event_type", "event_time", "ride_id", "city", "rider_id", "driver_id",
    "vehicle_type", "pickup", "dropoff", "duration_min", "distance_km", "fare_amount",
    "amount", "currency", "payment_method", "status", "cancelled_by", "reason",
)


def envelopes(events: DataFrame, region: DataFrame, least_tasks: int = 1) -> DataFrame:
    """Bus messages ``key, value, timestamp`` for every lifecycle event.

    ``to_json`` omits null fields, like the producer, which only writes the
    fields an event type carries.
    """
    f = event_fields(rides(events, region, least_tasks))
    value = F.when(F.col("n") % FAULT_NOT_JSON == 7, F.lit("not json")).otherwise(
        F.to_json(F.struct(*JSON_FIELDS))
    )
    return f.select(
        F.col("ride_id").alias("key"),
        value.alias("value"),
        F.col("at").alias("timestamp"),
    )


def overlay(bronze: DataFrame) -> DataFrame:
    """Drop the edge-overlay events (by their own date and defaulted city)."""
    def hit(event_type, pairs):
        conds = [(F.col("city") == c) & (F.col("event_date") == F.lit(d).cast("date")) for c, d in pairs]
        any_pair = conds[0]
        for c in conds[1:]:
            any_pair = any_pair | c
        return (F.col("event_type") == event_type) & any_pair

    drop = hit("ride_ended", OVERLAY_DROP_ENDED) | hit("payment_completed", OVERLAY_DROP_PAID)
    return bronze.filter(~F.coalesce(drop, F.lit(False)))


def seed_drivers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Driver master data in the seed-file layout."""
    nat = nation.select("n_nationkey", "n_name")
    k = F.col("s_suppkey")
    return supplier.join(nat, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        _str("driver_", k).alias("driver_id"),
        F.col("s_name").alias("driver_name"),
        ((F.lit(36) + k % 15) / F.lit(10.0)).alias("rating"),
        F.col("n_name").alias("home_zone"),
        _pick(VEHICLES, k % 4).alias("primary_vehicle"),
        F.date_add(F.lit("2022-01-01").cast("date"), (k % 1400).cast("int")).alias("joined_date"),
    )


def unlisted_drivers(bronze: DataFrame, drivers: DataFrame) -> DataFrame:
    """Seed rows of the drivers that events name and master data lacks: id and first day, the rest unknown."""
    seen = bronze.where("driver_id IS NOT NULL").groupBy("driver_id").agg(F.min("event_date").alias("joined_date"))
    rows = seen.join(drivers.select("driver_id"), "driver_id", "left_anti")
    return rows.select(*(F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in drivers.schema.fields))


def seed_riders(customer: DataFrame) -> DataFrame:
    """Rider master data in the seed-file layout."""
    k = F.col("c_custkey")
    return customer.select(
        _str("rider_", k).alias("rider_id"),
        F.col("c_name").alias("rider_name"),
        F.lower(F.col("c_mktsegment")).alias("segment"),
        F.date_add(F.lit("2022-01-01").cast("date"), (k % 1800).cast("int")).alias("signup_date"),
    )
