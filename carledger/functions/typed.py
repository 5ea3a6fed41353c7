"""Tolerant casts and ages."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = datetime.date | str | Column | None


def as_of_date(as_of: AsOf = None) -> Column:
    """The reference day: today unless given."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def to_float(c: Column, drop_nan: bool = True) -> Column:
    """Text -> 32-bit float, null if malformed; NaN becomes null too unless kept on request."""
    value = c.try_cast("float")
    return F.when(~F.isnan(value), value) if drop_nan else value


def to_int(c: Column) -> Column:
    return c.try_cast("int")


def to_date(c: Column) -> Column:
    """`2024`, `2024-1` and `2024-01` are the first day of the period; malformed is null."""
    return c.try_cast("date")


def age_years(day: Column, as_of: AsOf = None) -> Column:
    return (F.datediff(as_of_date(as_of), day) / F.lit(365.0)).cast("float")


def days_since(day: Column, as_of: AsOf = None) -> Column:
    return F.datediff(as_of_date(as_of), day)
