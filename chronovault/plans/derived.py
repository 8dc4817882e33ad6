"""Tables that follow from the stored facts month by month, renewed for the months a batch touches.

A renewal reads the touched months of the facts and replaces the same months of the derived table by dynamic partition overwrite, so
repeating it changes nothing and other months' files stay as they are. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.moments import monthly_moments
from ..operators.sketches import daily_sketches
from ..session import materialise
from ..sources.tables import append_facts, in_months, months_of, read_table
from .runs import table_paths

#: derived tables by name: how a month's rows are made from its facts, and their schema
DERIVED: dict[str, tuple[Callable[[DataFrame], DataFrame], object]] = {
    "moments": (monthly_moments, schemas.MOMENTS),
    "asset_sketches": (daily_sketches, schemas.ASSET_SKETCHES),
}


def derived_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def facts_of_months(spark: SparkSession, root: str, months: Sequence[date | None]) -> DataFrame:
    """The stored facts of some months; no other partition is listed or read."""
    return read_table(spark, table_paths(root)["facts"], schemas.STORED_FACTS).where(in_months(months))


def refresh_derived(spark: SparkSession, root: str, months: Sequence[date | None], names: Sequence[str] = tuple(DERIVED)) -> None:
    """Makes the months of the derived tables anew from the stored facts."""
    if not months:
        return
    facts = facts_of_months(spark, root, months)
    for name in names:
        make, schema = DERIVED[name]
        fresh = make(facts).select(*schema.names).hint("rebalance", "business_month")
        writer = fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("business_month").parquet(derived_path(root, name))


def append_and_refresh(
    spark: SparkSession, batch: DataFrame, root: str, skip_unchanged: bool = False, names: Sequence[str] = tuple(DERIVED)
) -> None:
    """Appends a batch of facts and renews the derived tables of its months.

    A failure between the two is mended by doing it again: the facts are stored already, and the months follow from the batch.
    """
    batch = materialise(spark, batch.select(*schemas.FACTS.names), "batch")
    append_facts(spark, batch, table_paths(root)["facts"], skip_unchanged)
    refresh_derived(spark, root, months_of(batch), names)


def read_derived(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_table(spark, derived_path(root, name), DERIVED[name][1])


def read_sketches(spark: SparkSession, root: str, start=None, end=None) -> DataFrame:
    """The sketches of the days from ``start`` to ``end``, both included."""
    sketches, month = read_derived(spark, root, "asset_sketches"), F.col("business_month")
    for bound, inside in ((start, lambda c, d: c >= d), (end, lambda c, d: c <= d)):
        if bound is not None:
            day = F.lit(bound).cast("date")
            sketches = sketches.where(inside(month, F.trunc(day, "month")) & inside(F.col("business_date"), day))
    return sketches
