"""Order-free half-up rounding helpers vs exact Decimal arithmetic."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from triplake.functions import half_up_avg, half_up_ratio, half_up_sum

cents = st.integers(min_value=0, max_value=10_000_000)
groups = st.lists(st.lists(cents, min_size=1, max_size=40), min_size=1, max_size=30)


def _q(x: Decimal) -> float:
    return float(x.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(groups)
def test_sum_and_avg_match_decimal(spark, gs):
    rows = [(g, c / 100.0) for g, vals in enumerate(gs) for c in vals]
    df = spark.createDataFrame(rows, "g int, v double").repartition(3)
    got = {r["g"]: (r["s"], r["a"]) for r in df.groupBy("g").agg(
        half_up_sum("v").alias("s"), half_up_avg("v").alias("a")).collect()}
    for g, vals in enumerate(gs):
        total = sum(Decimal(c) / 100 for c in vals)
        assert got[g] == (_q(total), _q(total / len(vals))), (g, vals)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(cents, st.integers(min_value=0, max_value=5000)), min_size=1, max_size=50))
def test_ratio_matches_decimal(spark, pairs):
    df = spark.createDataFrame([(i, c / 100.0, n) for i, (c, n) in enumerate(pairs)], "i int, num double, den long")
    got = {r["i"]: r["q"] for r in df.select("i", half_up_ratio("num", "den").alias("q")).collect()}
    for i, (c, n) in enumerate(pairs):
        assert got[i] == (None if n == 0 else _q(Decimal(c) / 100 / n)), (c, n)


def test_all_null_inputs_give_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    r = df.agg(half_up_sum("v").alias("s"), half_up_avg("v").alias("a")).first()
    assert (r["s"], r["a"]) == (None, None)
    assert df.agg(F.count("v")).first()[0] == 0


def _sums(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double").agg(
        half_up_sum("v").alias("s"), half_up_avg("v").alias("a")).first()


def test_any_double_gives_the_floating_result(spark):
    assert tuple(_sums(spark, [1e12, 0.25])) == (1000000000000.25, 500000000000.13)
    assert tuple(_sums(spark, [1e15, 1e15])) == (2e15, 1e15)
    assert _sums(spark, [1e300, 5.0])["s"] == 1e300
    assert _sums(spark, [float("inf"), 5.0])["s"] == float("inf")
    assert all(x != x for x in _sums(spark, [100.0] * 5 + [float("nan")]))
    assert tuple(_sums(spark, [None, 2.5])) == (2.5, 2.5)


def test_ratio_of_large_and_special_values(spark):
    rows = [(2e12, 4.0), (1e300, 2.0), (float("inf"), 2.0), (1.0, 0.0), (None, 2.0), (2e12, None)]
    got = [r["q"] for r in spark.createDataFrame(rows, "n double, d double").coalesce(1).select(
        half_up_ratio("n", "d").alias("q")).collect()]
    assert got == [5e11, 5e299, float("inf"), None, None, None]


def test_large_city_day_revenue(spark):
    from triplake.operators import gold as G

    day = spark.createDataFrame([("2024-01-01", "X", 4, 1.0, 2e12, 4)],
                                "metric_date string, city string, total_rides long, avg_duration_min double, revenue_pkr double, paid_rides long")
    assert G.fct_daily_city_metrics(day).first()["revenue_per_ride"] == 5e11


def test_small_and_large_values_add_up_whole(spark):
    assert spark.range(1_000_000).select(F.lit(4e-7).alias("v")).agg(half_up_sum("v").alias("s")).first()["s"] == 0.4
    assert _sums(spark, [1e15] * 3 + [0.01] * 5)["s"] == 3000000000000000.05 and _sums(spark, [1e9 - 0.01, 0.02])["s"] == 1000000000.01
    assert _sums(spark, [5e-324, 1e-300, 1e-30])["s"] == 0.0 and _sums(spark, [-1e22, 1e22, 0.37])["s"] == 0.37
    assert _sums(spark, [9e22] * 3)["s"] == 2.7e23


numbers = st.one_of(st.floats(allow_nan=False, allow_infinity=False, min_value=-1e22, max_value=1e22),
                    st.sampled_from([4e-7, 1e9, 1e15, 0.005, 12.345, 1e-12, -0.01, 999999999.995]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(numbers, min_size=1, max_size=60), st.randoms())
def test_sums_of_any_magnitude_have_no_order(spark, values, r):
    """Equal for every order and partitioning, and the exact decimal sum's rounding while that has 20 digits before the point."""
    from triplake.functions.numeric import merged_sums, partial_sum, rounded_total

    def both(vals, parts):
        df = spark.createDataFrame([(k % 3, v) for k, v in enumerate(vals)], "g int, v double").repartition(parts)
        one = df.agg(half_up_sum("v").alias("s"), half_up_avg("v").alias("a")).first()
        two = df.groupBy("g").agg(partial_sum("v").alias("p")).agg(rounded_total(merged_sums("p")).alias("s")).first()
        return one["s"], one["a"], two["s"]

    got = both(values, 1)
    again = list(values)
    r.shuffle(again)
    assert both(again, 4) == got and got[0] == got[2]
    # classes keep 37 places; below that nothing reaches the second place of so few values
    import decimal
    with decimal.localcontext(prec=400):
        total = sum(Decimal(repr(v)) for v in values)
        if abs(total) < Decimal("1e19"):
            assert abs(Decimal(repr(got[0])) - total) <= Decimal("0.00500000001") + abs(total) * Decimal("1e-15")


def test_nan_and_infinite_sums(spark):
    assert all(x != x for x in _sums(spark, [float("nan"), 4e-7, 1e15]))
    assert _sums(spark, [float("-inf"), 1e22])["s"] == float("-inf")
    assert _sums(spark, [float("inf"), float("-inf")])["s"] != _sums(spark, [1.0])["s"]
