"""Order-independent sums and one rounding rule for every measure.

Money arrives as DOUBLE. Adding doubles gives a total that depends on the order
of the rows, so sums are taken over whole cents in a LONG (exact, code-generated,
and an overflow raises instead of wrapping) and turned back at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def units(col: Column | str, scale: int = 2) -> Column:
    """Value as a whole number of 10**-scale units; null for NaN, so one broken value ends no sum."""
    col = F.col(col) if isinstance(col, str) else col
    return F.rint(F.nanvl(col.cast("double"), F.lit(None).cast("double")) * F.lit(float(10**scale))).cast("long")


def from_units(col: Column | str, scale: int = 2) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return col / F.lit(float(10**scale))


def exact_sum(col: Column | str, scale: int = 2) -> Column:
    return from_units(F.sum(units(col, scale)), scale)


def exact_avg(col: Column | str, scale: int = 2) -> Column:
    """Average whose numerator is an exact sum; null for an empty group."""
    return exact_sum(col, scale) / F.nullif(F.count(col), F.lit(0))


def round_half_up(col: Column, digits: int = 0) -> Column:
    """Round through a decimal so that x.xx5 always goes up."""
    return F.round(col.cast("decimal(38,10)"), digits).cast("double")


def ratio(num: Column, den: Column) -> Column:
    """num / den as double, null when den is zero or null."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def ratio_rounded(num: Column, den: Column, digits: int) -> Column:
    return round_half_up(ratio(num, den), digits)


def percent(num: Column, den: Column, digits: int = 1) -> Column:
    return round_half_up(ratio(num.cast("double") * F.lit(100.0), den), digits)


def fixed_text(col: Column, digits: int) -> Column:
    """Number with a fixed count of decimals, as text."""
    kind = f"decimal(30,{digits})"
    return F.round(col.cast("decimal(38,10)"), digits).cast(kind).cast("string")
