"""Data-quality checks: the layer gate and the model table tests.

A suite runs as ONE aggregate pass over its frame (one ``count_if`` per
check), then the single result row is unpivoted into one row per check, so
a suite costs one scan whatever its length. Null values pass every check
except not-null, and an empty frame passes everything.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.config import LakeConfig
from triplake.functions import count_if


class DataQualityError(RuntimeError):
    """Raised by the gate when any check fails; the pipeline stops."""


@dataclass(frozen=True)
class NotNull:
    column: str
    name = "expect_column_values_to_not_be_null"

    def violation(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class Between:
    column: str
    min_value: float | None = None
    max_value: float | None = None
    strict_min: bool = False
    strict_max: bool = False
    name = "expect_column_values_to_be_between"

    def violation(self) -> Column:
        c = F.col(self.column)
        bad = F.lit(False)
        if self.min_value is not None:
            bad = bad | ((c <= self.min_value) if self.strict_min else (c < self.min_value))
        if self.max_value is not None:
            bad = bad | ((c >= self.max_value) if self.strict_max else (c > self.max_value))
        return c.isNotNull() & bad


@dataclass(frozen=True)
class InSet:
    column: str
    values: tuple
    name = "expect_column_values_to_be_in_set"

    def violation(self) -> Column:
        c = F.col(self.column)
        return c.isNotNull() & ~c.isin(*self.values)


def bronze_rides_checks(cfg: LakeConfig) -> list:
    return [
        NotNull("ride_id"),
        Between("ride_duration_min", min_value=0),
        InSet("city", tuple(cfg.valid_cities)),
        Between("fare_amount", min_value=0, strict_min=True),
    ]


def silver_daily_checks(cfg: LakeConfig) -> list:
    return [
        NotNull("city"),
        InSet("city", tuple(cfg.valid_cities)),
        Between("revenue_pkr", min_value=0, strict_min=True),
        Between("total_rides", min_value=0),
        Between("avg_duration_min", min_value=0),
    ]


def run_suite(df: DataFrame, layer: str, checks: Sequence) -> DataFrame:
    """One row per check: layer, check_no, check, column, unexpected_count, passed."""
    return suite_report(df.agg(*violations(checks)), layer, checks)


def violations(checks: Sequence) -> list[Column]:
    """Aggregates c0, c1, ...: the rows that break each check. Sums of them over parts of a table are those of the whole."""
    return [count_if(chk.violation()).alias(f"c{i}") for i, chk in enumerate(checks)]


def suite_report(counts: DataFrame, layer: str, checks: Sequence) -> DataFrame:
    """The report of one row of ``violations``."""
    rows = F.array(*[
        F.struct(
            F.lit(i + 1).alias("check_no"),
            F.lit(chk.name).alias("check"),
            F.lit(chk.column).alias("column"),
            F.col(f"c{i}").alias("unexpected_count"),
        )
        for i, chk in enumerate(checks)
    ])
    return (
        counts.select(F.inline(rows))
        .select(
            F.lit(layer).alias("layer"), "check_no", "check", "column", "unexpected_count",
            (F.col("unexpected_count") == 0).alias("passed"),
        )
    )


def gate_report(bronze: DataFrame, silver_daily: DataFrame, cfg: LakeConfig, counted: DataFrame | None = None) -> DataFrame:
    """All nine gate checks: Bronze ended rides, then Silver daily metrics.

    ``counted`` has the Bronze checks' violations by date; they are added up instead of reading the rides.
    """
    checks = bronze_rides_checks(cfg)
    if counted is None:
        rides = run_suite(bronze.filter(F.col("event_type") == "ride_ended"), "bronze_rides", checks)
    else:
        total = counted.agg(*[F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i in range(len(checks))])
        rides = suite_report(total, "bronze_rides", checks)
    return rides.unionByName(run_suite(silver_daily, "silver_daily_city_metrics", silver_daily_checks(cfg)))


def layer_summary(report: DataFrame) -> DataFrame:
    """Per layer: number of checks, failed checks, pass flag."""
    return report.groupBy("layer").agg(
        F.count(F.lit(1)).alias("checks"),
        count_if(~F.col("passed")).alias("failed"),
        F.bool_and("passed").alias("passed"),
    )


def enforce(report: DataFrame) -> list:
    """Raise DataQualityError if any check failed (the report has <= 9 rows)."""
    rows = report.collect()
    failed = [r for r in rows if not r["passed"]]
    if failed:
        detail = "; ".join(
            f"{r['layer']}: {r['check']} on '{r['column']}': {r['unexpected_count']} bad value(s)"
            for r in failed
        )
        raise DataQualityError(f"{len(failed)} of {len(rows)} checks failed: {detail}")
    return rows


# -- model table tests ------------------------------------------------------- #
TEST_COLUMNS = ("model", "column_name", "test", "failures", "status")


def _result(df: DataFrame, model: str, column: str, test: str) -> DataFrame:
    """``df`` has one row with ``failures``; decorate it as a test result."""
    return df.select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit(test).alias("test"),
        F.col("failures"),
        F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("status"),
    )


def test_unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """Failures = values occurring more than once (nulls ignored).

    Partial aggregation combines map-side, so a hot value costs one row per
    task in the shuffle.
    """
    dup = (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        .agg(count_if(F.col("n") > 1).alias("failures"))
    )
    return _result(dup, model, column, "unique")


def column_tests(df: DataFrame, model: str, not_null: Sequence[str] = (),
                 accepted: tuple[str, Sequence[str]] | None = None) -> DataFrame:
    """``not_null`` tests and an ``accepted_values`` test of one table in ONE pass.

    not_null failures = null rows; accepted_values failures = distinct
    non-null values outside the list (one failing row each, nulls ignored).
    """
    aggs = [count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(not_null)]
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit("not_null").alias("test"),
                     F.col(f"n{i}").alias("failures")) for i, c in enumerate(not_null)]
    if accepted is not None:
        column, values = accepted
        c = F.col(column)
        aggs.append(F.count_distinct(F.when(c.isNotNull() & ~c.isin(*values), c)).alias("av"))
        rows.append(F.struct(F.lit(column).alias("column_name"), F.lit("accepted_values").alias("test"),
                             F.col("av").alias("failures")))
    return df.agg(*aggs).select(F.inline(F.array(*rows))).select(
        F.lit(model).alias("model"), "column_name", "test", "failures",
        F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("status"),
    )


def test_not_null(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """One pass over the table for all not-null tests on it."""
    return column_tests(df, model, not_null=columns)


def test_accepted_values(df: DataFrame, model: str, column: str, values: Sequence[str]) -> DataFrame:
    """Failures = distinct values outside the accepted list (nulls ignored)."""
    return column_tests(df, model, accepted=(column, values))


def test_relationships(child: DataFrame, model: str, column: str,
                       parent: DataFrame, parent_column: str) -> DataFrame:
    """Failures = child rows whose non-null key has no parent row."""
    keys = parent.select(F.col(parent_column).alias(column)).filter(F.col(column).isNotNull())
    orphans = (
        child.select(column).filter(F.col(column).isNotNull())
        .join(keys.distinct(), column, "left_anti")
        .agg(F.count(F.lit(1)).alias("failures"))
    )
    return _result(orphans, model, column, "relationships")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dim_tests(gold: dict) -> DataFrame:
    """Tests of the two dimensions (run before the facts that need them)."""
    d, r = gold["dim_driver"], gold["dim_rider"]
    return _union([
        test_unique(d, "dim_driver", "driver_id"),
        test_not_null(d, "dim_driver", ["driver_id"]),
        test_unique(r, "dim_rider", "rider_id"),
        test_not_null(r, "dim_rider", ["rider_id"]),
    ])


def fact_tests(gold: dict, cfg: LakeConfig, other_rides: DataFrame | None = None) -> DataFrame:
    """Tests of the three facts; each table is scanned once for its column tests.

    ``other_rides`` are rides besides those in ``gold`` that share an id with one of them: they count for ``unique``.
    """
    f = gold["fct_rides"]
    ids = f.select("ride_id") if other_rides is None else f.select("ride_id").unionByName(other_rides.select("ride_id"))
    return _union([
        test_unique(ids, "fct_rides", "ride_id"),
        column_tests(f, "fct_rides", ["ride_id", "city", "revenue"], ("city", cfg.valid_cities)),
        test_relationships(f, "fct_rides", "driver_id", gold["dim_driver"], "driver_id"),
        test_not_null(gold["fct_daily_city_metrics"], "fct_daily_city_metrics",
                      ["metric_date", "total_rides"]),
        test_not_null(gold["fct_hourly_demand"], "fct_hourly_demand",
                      ["demand_date", "hour_of_day"]),
    ])


def model_tests(gold: dict, cfg: LakeConfig) -> DataFrame:
    """The 14 table tests over the Gold models (dims first, like a build)."""
    return dim_tests(gold).unionByName(fact_tests(gold, cfg))
