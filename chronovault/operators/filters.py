"""Optional-argument filters; everything stays a plain predicate that reaches the scan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import iso_instant


def where_equal(df: DataFrame, **values: object) -> DataFrame:
    """Equality on each column whose value is given."""
    for column, value in values.items():
        if value is not None:
            df = df.where(F.col(column) == F.lit(value))
    return df


def where_in(df: DataFrame, column: str, values: Iterable[object] | DataFrame | None) -> DataFrame:
    """Membership in a literal list, or a semi-join when the values are a DataFrame."""
    if values is None:
        return df
    if isinstance(values, DataFrame):
        return df.join(values.select(column), column, "left_semi")
    return df.where(F.col(column).isin(*values))


def where_not_in(df: DataFrame, column: str, values: Iterable[object] | DataFrame) -> DataFrame:
    """The rows that ``where_in`` leaves out; null is in no list."""
    if isinstance(values, DataFrame):
        return df.join(values.select(column), column, "left_anti")
    return df.where(~F.coalesce(F.col(column).isin(*values), F.lit(False)))


def business_range(df: DataFrame, start=None, end=None, end_inclusive: bool = True) -> DataFrame:
    day = F.col("business_date")
    if start is not None:
        df = df.where(day >= F.lit(start).cast("date"))
    if end is not None:
        bound = F.lit(end).cast("date")
        df = df.where(day <= bound if end_inclusive else day < bound)
    return df


def as_of(df: DataFrame, instant=None) -> DataFrame:
    """Versions known at ``instant`` (ISO text or datetime); text that is not ISO filters nothing."""
    if instant is None:
        return df
    bound = iso_instant(F.lit(instant)) if isinstance(instant, str) else F.date_trunc("second", F.lit(instant))
    # the bound is constant, so one side of the disjunction folds away and the other is pushed down
    return df.where(bound.isNull() | (F.col("system_date") <= bound))


def not_deleted(df: DataFrame) -> DataFrame:
    """Drops markers; the flag is absent (null) on live rows."""
    return df.where(~F.col("deleted").eqNullSafe(F.lit(True)))


def present(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def page(df: DataFrame, *order: str | Column, limit: int, offset: int = 0, after: object = None) -> DataFrame:
    """A page of a listing in a fixed order; plans as a top-k, not a full sort.

    An offset gathers all rows before it, so deep pages are better asked for by ``after``, the last value of the
    first order column on the page before, which must be unique and ascending.
    """
    if after is not None:
        if not isinstance(order[0], str):
            raise ValueError("after needs the name of an ascending column")
        df = df.where(F.col(order[0]) > F.lit(after))
    return df.orderBy(*order).offset(offset).limit(limit)
