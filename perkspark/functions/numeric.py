"""Numeric helpers with engine-independent results.

Spark's ``round`` on a double rounds HALF_UP on the double's shortest decimal
form.  Sums of many doubles depend on summation order; ``exact_sum`` and
``exact_mean`` avoid that without rounding a value or failing on one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def _exact_part(col: Column) -> Column:
    """``col`` as a decimal where that loses nothing, else null."""
    number = col.cast("double")
    exact = number.try_cast("decimal(24,9)")
    return F.when(exact.cast("double") == number, exact)


def exact_sum(c: Column | str) -> Column:
    """Sum of doubles; null without a value.

    Values that nine decimals hold exactly are summed as decimals, so that the
    order of rows does not matter; all others (huge or finer ones, infinities)
    are added as the doubles they are.
    """
    return _exact_sum(c, lambda part: F.sum(part))


def exact_sum_over(c: Column | str, window: WindowSpec) -> Column:
    """``exact_sum`` over a window."""
    return _exact_sum(c, lambda part: F.sum(part).over(window))


def _exact_sum(c: Column | str, total: Callable[[Column], Column]) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    exact = _exact_part(col)
    rest = total(F.when(exact.isNull(), col.cast("double")))
    whole = total(exact).cast("double")
    return F.when(rest.isNull(), whole).otherwise(F.coalesce(whole, F.lit(0.0)) + rest)


def exact_mean(c: Column | str, digits: int = 2) -> Column:
    """Mean of doubles by ``exact_sum``, rounded HALF_UP to ``digits``."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(F.try_divide(exact_sum(col), F.count(col)), digits)


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """``round(part / whole * 100, digits)``; null when ``whole`` is 0."""
    return F.round(F.try_divide(part, whole) * 100, digits)


def sum_parts(value: Column) -> dict[str, Column]:
    """Aggregates from which sums can be added and subtracted (``sum_of_parts``).

    A value below 1e19 is a nine-decimal number, summed exactly, and what that
    leaves of the double (nothing for money).  Larger and non-finite values are
    counted and summed on their own.
    """
    number = value.cast("double")
    near = number.try_cast("decimal(28,9)")
    odd = number.isNotNull() & near.isNull()
    return {
        "values": F.count(number),
        "whole": F.sum(near).cast("decimal(38,9)"),
        "rest": F.sum(number - near.cast("double")),
        "odd": F.count_if(odd),
        "odd_sum": F.sum(F.when(odd, number)),
    }


def sum_of_parts(values: Column, whole: Column, rest: Column, odd: Column, odd_sum: Column) -> Column:
    """The sum behind ``sum_parts``; null without a value."""
    usual = whole.cast("double") + rest
    return F.when(values > 0, F.when(odd > 0, usual + odd_sum).otherwise(usual))
