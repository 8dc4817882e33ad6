"""Guarded ratios and the display rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Null where the denominator is null or zero."""
    return F.try_divide(numerator, denominator)


def simple_return(current: Column, previous: Column) -> Column:
    return ratio(current - previous, previous)


def percent_change(first: Column, last: Column) -> Column:
    return ratio(last - first, first) * 100


def round_columns(df, digits: dict[str, int]):
    """Display rounding, kept apart from the computation."""
    return df.withColumns({name: F.round(name, n) for name, n in digits.items()})
