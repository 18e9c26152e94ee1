"""Order-independent arithmetic.

Sums of doubles depend on the order in which partitions arrive, so a rerun on a
cluster gives other last digits. Amounts have a fixed number of decimals, hence
they are summed as integers and turned into doubles once, at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed_point(amount: Column, scale: int) -> Column:
    """Amount as a whole number of 10**-scale units; NaN counts as missing."""
    value = amount.cast("double")
    return F.when(~F.isnan(value), F.round(value * float(10 ** scale)).cast("bigint"))


def square(units: Column) -> Column:
    """Square of a fixed-point amount, wide enough that long sums stay exact."""
    wide = units.cast("decimal(19,0)")
    return (wide * wide).cast("decimal(38,0)")


def exact_mean(total: Column, n: Column, scale: int) -> Column:
    """Mean of fixed-point units as a double; NULL without rows."""
    return F.when(n > 0, total.cast("double") / n / float(10 ** scale))


def exact_std(total: Column, squares: Column, n: Column, scale: int) -> Column:
    """Sample standard deviation from exact moments; NULL below two rows."""
    wide_n = n.cast("decimal(19,0)")
    wide_total = total.cast("decimal(19,0)")
    exact = (F.try_multiply(wide_n, squares) - wide_total * wide_total).cast("double")
    # Only reached when n * sum(x^2) needs more than 38 digits.
    rounded = squares.cast("double") * n - total.cast("double") * total.cast("double")
    spread = F.coalesce(exact, rounded)
    return F.when(n > 1, F.sqrt(spread / (n * (n - 1))) / float(10 ** scale))


def whole_number(text: Column) -> Column:
    """Integer from text such as '12' or '12.0'; NULL when it has a fraction."""
    as_double = text.try_cast("double")
    whole = F.when(as_double == F.floor(as_double), as_double.try_cast("bigint"))
    return F.coalesce(text.try_cast("bigint"), whole)
