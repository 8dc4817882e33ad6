"""Moving a stored table with text system dates into the fact store, month by month, so that a stopped run goes on where it was."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..session import materialise
from ..sources.tables import append_facts, in_months, migrate_system_dates, months_of, read_table
from .runs import table_paths


def _paths(root: str) -> dict[str, str]:
    return {name: f"{root.rstrip('/')}/{name}" for name in ("unparseable", "migration_log")}


def read_unparseable(spark: SparkSession, root: str) -> DataFrame:
    """Rows whose system date could not be read, as they were."""
    return read_table(spark, _paths(root)["unparseable"], schemas.LEGACY_FACTS)


def migration_log(spark: SparkSession, root: str) -> DataFrame:
    """Rows by month and status of the months that are done."""
    return read_table(spark, _paths(root)["migration_log"], schemas.MIGRATION_LOG)


def _put_months(rows: DataFrame, path: str) -> None:
    """Replaces the months that the rows stand in."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("business_month").parquet(path)


def _groups(months: Sequence[date | None], size: int) -> Iterator[Sequence[date | None]]:
    for i in range(0, len(months), size):
        yield months[i:i + size]


def _report(migrated: DataFrame) -> DataFrame:
    return migrated.groupBy("business_month", "status").agg(F.count(F.lit(1)).alias("rows"))


def migrate_store(spark: SparkSession, legacy: str, root: str, dry_run: bool = True, months_at_a_time: int = 12) -> DataFrame:
    """Moves the facts of the folder ``legacy``, partitioned by month, into the store below ``root``; returns rows by month and status.

    A dry run only counts. Rows with a readable date are appended if their id is absent, the others kept as they were in a table of
    their own. A month is logged after both are written, so a run that is stopped leaves its months undone or repeatable, and the
    next run leaves logged months out. Rows without a business date are a month of their own. The legacy table stays.
    """
    stored = read_table(spark, legacy, schemas.LEGACY_FACTS)
    if dry_run:
        return _report(migrate_system_dates(stored))
    # months by the partition folders, one value for each
    done = set(months_of(migration_log(spark, root), "business_month"))
    months = [m for m in months_of(stored, "business_month") if m not in done]
    for group in _groups(sorted(months, key=lambda m: m or date.min), months_at_a_time):
        rows = materialise(spark, migrate_system_dates(stored.where(in_months(group))), "migrated")
        append_facts(spark, rows.where("status = 'migrated'").select(*schemas.FACTS.names), table_paths(root)["facts"])
        unread = rows.where("status = 'unparseable'").withColumn("system_date", F.col("system_date_text"))
        _put_months(unread.select(*schemas.LEGACY_FACTS.names), _paths(root)["unparseable"])
        _put_months(_report(rows).select(*schemas.MIGRATION_LOG.names).coalesce(1), _paths(root)["migration_log"])
    return migration_log(spark, root)
