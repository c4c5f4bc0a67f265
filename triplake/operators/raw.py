"""RAW: the ride-grain table and warehouse-style column names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplake.operators.bronze import slice_type

RIDE_COLUMNS = (
    "ride_id", "rider_id", "driver_id", "vehicle_type", "city",
    "event_date", "ride_duration_min", "distance_km", "fare_amount",
)


def build_rides(bronze: DataFrame) -> DataFrame:
    """Ended rides left-joined to their payments on ``ride_id``.

    Unpaid rides stay (null payment columns); a duplicated payment fans the
    ride out, which the ``unique`` table test reports.

    Planned as (ended INNER JOIN payments) UNION ALL (ended ANTI JOIN the
    distinct paid ride ids), which is exactly the left join. At scale both
    sides are shuffled by ride; written this way AQE can split a hot ride on
    EITHER side of the inner join (a left join only lets it split the left
    side), the anti join's right side is de-duplicated map-side so a hot key
    collapses to one row, and the ended side's exchange is the same in both
    branches, so Spark shuffles it once and reuses it.
    """
    # both branches read the ended slice through one identical subplan (the
    # stored column order), so its shuffle is planned once and reused
    ended = slice_type(bronze, "ride_ended")
    ended = ended.select(*[c for c in ended.columns if c in RIDE_COLUMNS])
    keyed = ended.filter(F.col("ride_id").isNotNull())
    pay = slice_type(bronze, "payment_completed").select(
        "ride_id", F.col("amount").alias("paid_amount"), "payment_method"
    )
    no_payment = [F.lit(None).cast("double").alias("paid_amount"),
                  F.lit(None).cast("string").alias("payment_method")]
    matched = keyed.join(pay, "ride_id", "inner")
    unpaid = keyed.join(pay.select("ride_id").distinct(), "ride_id", "left_anti").select(
        *RIDE_COLUMNS, *no_payment)
    # a null ride id never matches (Bronze drops them; kept here for exactness)
    null_key = ended.filter(F.col("ride_id").isNull()).select(*RIDE_COLUMNS, *no_payment)
    return (matched.unionByName(unpaid).unionByName(null_key)
            .select(*RIDE_COLUMNS, "paid_amount", "payment_method"))


def upper_columns(df: DataFrame) -> DataFrame:
    """Upper-case every column name (unquoted warehouse identifiers)."""
    return df.toDF(*[c.upper() for c in df.columns])


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])
