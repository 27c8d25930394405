"""Exact sums over amounts that are stored as doubles with a fixed number of decimals.

Summing doubles gives a result that depends on how the rows were split over
tasks. Whole units (cents) do not have that problem, and turning a double into
a bigint is far cheaper than casting it to a decimal.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


# Beyond this a number of units does not fit a bigint.
BIGINT_END = 2.0**63


def units(col: Column, scale: int = 2) -> Column:
    """The amount in whole units of ``10**-scale``, as bigint.

    An amount that is not a whole number of units, not finite or too large for a
    bigint fails the query, whatever ``spark.sql.ansi.enabled`` says. What a double
    is off by its own rounding does not count.
    """
    value = col * F.lit(10.0**scale)
    whole = F.rint(value)
    # Not true of NaN, which Spark puts above every number, nor of infinities.
    near = F.abs(value - whole) <= F.lit(1e-6) + F.abs(value) * F.lit(2.0**-50)
    fits = near & (F.abs(value) < F.lit(BIGINT_END))
    text = F.concat(F.lit(f"not a whole number of 1e-{scale} units: "), col.cast("string"))
    return F.when(col.isNull() | fits, whole.cast("bigint")).otherwise(F.raise_error(text))


def exact_sum(units_col: Column) -> Column:
    """Sum of bigint units as a decimal.

    One bigint could overflow over very many rows. The high and low parts are
    summed apart, each as a bigint, which is several times faster than summing
    decimals and holds for 9e12 rows per group with amounts of up to 1e12 units.
    """
    part = F.lit(1_000_000)
    high = F.sum(F.call_function("div", units_col, part)).cast("decimal(38,0)")
    low = F.sum(units_col % part).cast("decimal(38,0)")
    return high * F.lit(Decimal(1_000_000)) + low


def amount(units_sum: Column, scale: int, places: int = 2) -> Column:
    """A sum of units as a double amount, rounded half up to ``places`` decimals."""
    step = F.lit(Decimal(1).scaleb(-scale))
    return F.round(units_sum * step, places).cast("double")


def mean(units_sum: Column, scale: int, count: Column) -> Column:
    """A sum of units over a count, as a double."""
    return units_sum.cast("double") / F.lit(10.0**scale) / count
