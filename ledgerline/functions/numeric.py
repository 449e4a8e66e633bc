"""Exact decimal rounding helpers (JVM-side Column expressions only).

``round(avg(x), d)`` on a warehouse NUMERIC is exact and rounds half away from
zero. Spark's ``avg`` on decimals keeps only scale+4 digits and ``avg`` on ints
is a double, so both can round a tie the wrong way. These helpers compute the
rounded quotient with integer arithmetic on DECIMAL(38,0) instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _dec(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def half_up_div(num: Column, den: Column, digits: int, num_scale: int = 0) -> Column:
    """round((num * 10^-num_scale) / den, digits), half away from zero.

    ``num`` is an integer amount of 10^-num_scale units, ``den`` a positive
    count. Result is DECIMAL(38, digits); NULL when ``den`` is 0 or NULL.
    """
    if digits < num_scale:
        raise ValueError("digits must be >= num_scale")
    p = 10 ** (digits - num_scale)
    n = _dec(num)
    d = _dec(F.nullif(den, F.lit(0)))
    q = F.call_function("div", F.abs(n) * F.lit(2 * p) + d, d * F.lit(2))
    signed = F.when(n < 0, -q).otherwise(q)
    return (_dec(signed) / F.lit(10 ** digits)).cast(f"decimal(38,{digits})")


def pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """round(100.0 * part / nullif(whole, 0), digits), exact."""
    return half_up_div(part * F.lit(100), whole, digits)


def avg_half_up(total: Column, count: Column, digits: int, scale: int = 0) -> Column:
    """round(avg, digits) from a sum of DECIMAL(.., scale) values and their count."""
    units = (total * F.lit(10 ** scale)).cast("decimal(38,0)") if scale else total
    return half_up_div(units, count, digits, scale)


def to_units(c: Column, scale: int) -> Column:
    """Exact integer amount of 10^-scale units of a DECIMAL(.., scale) column."""
    return (c * F.lit(10 ** scale)).cast("decimal(38,0)")
