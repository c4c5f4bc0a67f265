"""Post-load verification: row counts, orphan report, preview."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplake.functions import count_if

PREVIEW_COLUMNS = ("ride_id", "ride_date", "vehicle_type", "rider_segment",
                   "driver_rating", "fare_amount", "revenue", "payment_method")


def row_counts(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """One row per (layer, table) with its row count, as one plan."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count")
        for (layer, name), df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def orphans(fct_rides: DataFrame) -> DataFrame:
    """Rides without a driver match, without a rider match, and in total."""
    return fct_rides.agg(
        count_if(F.col("driver_name").isNull()).alias("orphan_drivers"),
        count_if(F.col("rider_name").isNull()).alias("orphan_riders"),
        F.count(F.lit(1)).alias("total_rides"),
    )


def verdict(orphan_row) -> str:
    """OK when every ride found its driver and its rider, else WARNING."""
    return "WARNING" if orphan_row["orphan_drivers"] or orphan_row["orphan_riders"] else "OK"


def preview(fct_rides: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rides by id (a top-k: each task keeps n rows)."""
    return fct_rides.select(*PREVIEW_COLUMNS).orderBy("ride_id").limit(n)
