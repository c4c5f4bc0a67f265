"""Gate suites and table tests: null handling, empty frames, verdict."""

import pytest

from tests.conftest import plan_text

from triplake.config import LakeConfig
from triplake.operators import quality as Q


def test_all_null_column_passes_range_and_set_but_fails_not_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    res = {r["check"]: r["unexpected_count"] for r in Q.run_suite(df, "x", [
        Q.Between("v", min_value=0), Q.InSet("v", (1.0,)), Q.NotNull("v")]).collect()}
    assert res == {"expect_column_values_to_be_between": 0, "expect_column_values_to_be_in_set": 0,
                   "expect_column_values_to_not_be_null": 2}


def test_empty_frame_passes(spark):
    df = spark.createDataFrame([], "city string, revenue_pkr double, total_rides long, avg_duration_min double")
    rows = Q.run_suite(df, "silver", Q.silver_daily_checks(LakeConfig())).collect()
    assert len(rows) == 5 and all(r["passed"] for r in rows)


def test_strict_and_inclusive_minimum(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (-1.0,)], "v double")
    res = [r["unexpected_count"] for r in Q.run_suite(df, "x", [
        Q.Between("v", min_value=0), Q.Between("v", min_value=0, strict_min=True)]).collect()]
    assert res == [1, 2]


def test_suite_is_one_pass(spark):
    df = spark.createDataFrame([(1.0, "a")], "v double, c string")
    rep = Q.run_suite(df, "x", [Q.NotNull("v"), Q.Between("v", min_value=0), Q.InSet("c", ("a",))])
    plan = plan_text(rep)
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") == 1


def test_gate_raises_on_failure(spark):
    df = spark.createDataFrame([("Lahore", 0.0, 1, 1.0)],
                               "city string, revenue_pkr double, total_rides long, avg_duration_min double")
    rep = Q.run_suite(df, "silver", Q.silver_daily_checks(LakeConfig()))
    with pytest.raises(Q.DataQualityError, match="2 of 5 checks failed"):
        Q.enforce(rep)


def test_accepted_values_counts_distinct_bad_values_ignoring_nulls(spark):
    df = spark.createDataFrame([("A",), ("B",), ("B",), (None,), ("Karachi",)], "city string")
    assert Q.test_accepted_values(df, "m", "city", ["Karachi"]).first()["failures"] == 2


def test_unique_and_not_null(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert Q.test_unique(df, "m", "k").first()["failures"] == 1
    assert Q.test_not_null(df, "m", ["k"]).first()["failures"] == 1
