"""Rounded sums, averages and ratios that do not depend on summation order.

Rounding a floating sum or average to 2 places can flip on a .xx5 tie depending on the order rows were added, which differs
between runs and partitionings. Here a double counts as the decimal number it prints as (at most 17 digits). By magnitude
every value goes to one of the ``CLASSES``, each a decimal wide enough for all 17 digits of its values and for the sum of
1e15 of them, so a class's sum is exact and has no order. The class sums are put together once, in the order of the classes,
and rounded half-up: values of 4e-7 or 1e15 add up as exactly as cents, in one group with them.

Digits after the 37th place are cut. NaN, the infinities and values of 1e23 and more, which have no decimal places to round,
add up as doubles, as does any sum that they are part of. Nothing raises and nothing becomes null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# (bound, decimal places): a class holds the values below its bound that the class before does not hold.
CLASSES = ((1e-18, 37), (1e-12, 35), (1e-6, 29), (1.0, 23), (1e6, 17), (1e12, 11), (1e18, 5), (1e23, 0))
TOTAL = "decimal(38,18)"
# Spark keeps 10 places of such a quotient; a decimal(38, s) numerator would leave only 6, and a second rounding from
# there can move a result near a .xx5 tie.
NUMERATOR, DENOMINATOR = "decimal(28,6)", "decimal(18,6)"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def class_sums(col: str | Column) -> list[Column]:
    """Aggregates: the exact sum of each class (null without values) and, last, the double sum of all other values."""
    c = _c(col).cast("double")
    size, low, sums = F.abs(c), None, []
    for bound, places in CLASSES:
        inside = size < bound if low is None else (size >= low) & (size < bound)
        sums.append(F.sum(F.when(inside, c).cast(f"decimal(38,{places})")))
        low = bound
    return [*sums, F.sum(F.when(~(size < low), c))]


def partial_sum(col: str | Column) -> Column:
    """``class_sums`` as one struct, for a first level of aggregation."""
    return F.struct(*[s.alias(f"s{k}") for k, s in enumerate(class_sums(col))])


def merged_sums(parts: str | Column) -> list[Column]:
    """Aggregates: ``class_sums`` of all rows from the structs of a first level."""
    return [F.sum(_c(parts)[f"s{k}"]) for k in range(len(CLASSES) + 1)]


def rounded_total(sums: list[Column], den: Column | None = None, digits: int = 2, first: int | None = None) -> Column:
    """``round(sum / den, digits)`` half-up as double, of ``class_sums``; null when den is 0 or null.

    With ``first`` the sum itself is rounded to that many places before the division.
    """
    *classes, other = sums
    exact, floating = F.lit(0).cast(TOTAL), F.lit(0.0)
    for s, (_, places) in reversed(list(zip(classes, CLASSES))):
        exact = (exact + F.coalesce(s, F.lit(0).cast(f"decimal(38,{places})")).try_cast(TOTAL)).try_cast(TOTAL)
        floating = floating + F.coalesce(s.cast("double"), F.lit(0.0))
    floating = floating + F.coalesce(other, F.lit(0.0))
    if first is not None:
        exact, floating = F.round(exact, first).try_cast(TOTAL), F.round(floating, first)
    if den is not None:
        exact, floating = F.try_divide(exact, den), F.try_divide(floating, den)
    whole = F.coalesce(F.when(other.isNull(), F.round(exact, digits).cast("double")), F.round(floating, digits))
    return F.when(F.coalesce(*[s.cast("double") for s in sums]).isNotNull(), whole)


def half_up_sum(col: str | Column, digits: int = 2) -> Column:
    """``round(sum(col), digits)``; null when every input is null."""
    return rounded_total(class_sums(col), digits=digits)


def half_up_avg(col: str | Column, digits: int = 2) -> Column:
    """``round(avg(col), digits)`` over non-null inputs; null if there are none."""
    return rounded_total(class_sums(col), F.count(_c(col)), digits)


def half_up_ratio(num: str | Column, den: str | Column, digits: int = 2) -> Column:
    """``round(num / den, digits)`` for row values; null when ``den`` is 0 or null.

    The quotient is a decimal where both are decimals of six places, else a double.
    """
    num, den = _c(num).cast("double"), _c(den).cast("double")
    parts = [(v, v.try_cast(kind)) for v, kind in ((num, NUMERATOR), (den, DENOMINATOR))]
    whole = [exact.cast("double") == v for v, exact in parts]
    exact = F.try_divide(parts[0][1], parts[1][1])
    return F.when(whole[0] & whole[1], F.round(exact, digits).cast("double")).otherwise(F.round(F.try_divide(num, den), digits))
