"""Arithmetic of the published figures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def average(total: Column, n: Column) -> Column:
    """``total / n`` as a double, and 0.0 where there is nothing to average."""
    return F.when(n == 0, F.lit(0.0)).otherwise(total.cast("double") / n)


def hundredths(total: Column, n: Column) -> Column:
    """``total / n`` to two decimals, half up, as an integer count of hundredths.

    Integers only: engines disagree on how a double that sits next to a tie is rounded.
    """
    return F.when(n == 0, F.lit(0)).otherwise(whole_quotient(200 * total + n, 2 * n))


def two_decimals(count: Column) -> Column:
    """An integer count of hundredths as it is shown: 350 is 3.50."""
    whole = whole_quotient(count, F.lit(100)).cast("string")
    return F.concat(whole, F.lit("."), F.lpad(F.pmod(count, F.lit(100)).cast("string"), 2, "0"))


def whole_quotient(dividend: Column, divisor: Column) -> Column:
    """Integer division, exact over the whole BIGINT range."""
    return F.call_function("div", dividend, divisor)


def floor_quotient(dividend: Column, divisor: Column) -> Column:
    """Integer division rounded down, also below zero."""
    return whole_quotient(dividend - F.pmod(dividend, divisor), divisor)


def floor_at_one(count: Column) -> Column:
    """Counts as drawn: an edge of weight 0 is drawn with weight 1."""
    return F.when(count == 0, F.lit(1)).otherwise(count)
