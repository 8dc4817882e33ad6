"""Version selection over the bitemporal key.

Each pick is ``row_number() <= k``, which Spark plans with a WindowGroupLimit below the
shuffle: a task forwards at most k rows per key, so a key that holds a third of the table
costs the reducer k rows per map task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed import COMMON_INDICATORS
from ..functions.metrics import metric
from .filters import as_of, business_range, not_deleted, page, where_equal, where_in

KEY = ["asset_id", "data_source_id", "business_date"]


def newest() -> list[Column]:
    """Newest version first."""
    return [F.desc("system_date"), F.desc("ingest_id")]


def latest_day() -> list[Column]:
    """Latest business date first, its newest version first."""
    return [F.desc("business_date"), *newest()]


def top_versions(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1) -> DataFrame:
    """The first ``k`` rows of every key in the given order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= k).drop("_rank")


def pick_latest(df: DataFrame, keys: Sequence[str], tombstones: str = "ignore") -> DataFrame:
    """The newest version per key.

    ``tombstones``: ``ignore`` drops markers before the pick (a marker hides nothing),
    ``include`` lets a marker win, ``apply`` lets it win and then drops it.
    """
    if tombstones not in ("ignore", "include", "apply"):
        raise ValueError(f"unknown tombstone mode: {tombstones}")
    if tombstones == "ignore":
        df = not_deleted(df)
    latest = top_versions(df, keys, newest())
    return not_deleted(latest) if tombstones == "apply" else latest


def latest_versions(
    facts: DataFrame, asset_ids: Iterable[str] | DataFrame | None = None,
    start=None, end=None, as_of_instant=None, tombstones: str = "ignore",
) -> DataFrame:
    """Newest version per (asset, source, business date)."""
    rows = as_of(business_range(where_in(facts, "asset_id", asset_ids), start, end), as_of_instant)
    return pick_latest(rows, KEY, tombstones)


def latest_by_asset(
    facts: DataFrame, asset_id: str | None = None, source_id: str | None = None,
    start=None, end=None, as_of_instant=None, limit: int | None = None,
    tombstones: str = "ignore", end_inclusive: bool = True,
) -> DataFrame:
    """Newest version per (asset, business date) across sources.

    ``limit`` keeps the newest business dates of every asset.
    """
    rows = where_equal(facts, asset_id=asset_id, data_source_id=source_id)
    rows = as_of(business_range(rows, start, end, end_inclusive), as_of_instant)
    latest = pick_latest(rows, ["asset_id", "business_date"], tombstones)
    return latest if limit is None else top_versions(latest, ["asset_id"], [F.desc("business_date")], limit)


def asof_join(requests: DataFrame, facts: DataFrame, keys: Sequence[str] = ("asset_id", "business_date"), tombstones: str = "ignore") -> DataFrame:
    """Each request with the newest version of its key that was known at its ``instant``, null columns where there was none.

    ``requests`` has the keys, ``instant`` (a timestamp) and any further columns; every request stays, repeated ones too. A
    request without an instant asks for the newest version, one with a null key finds nothing; versions without a system date are
    never known. Of versions of one system date the largest id is the newest. ``tombstones`` as in ``pick_latest``; with ``apply`` a
    marker that wins gives nulls. The versions' columns but the keys are added; a request's column of the same name is
    replaced, so rename it before.

    Requests and versions stand in one order of system time, and a request takes the last version before it. The order is
    cut into cells of (key, system hour): what is in a task is one hour of one key, or one row for each cell of a key.
    """
    if tombstones not in ("ignore", "include", "apply"):
        raise ValueError(f"unknown tombstone mode: {tombstones}")
    keys = list(keys)
    added = [c for c in facts.columns if c not in keys]
    versions = facts.where(F.col("system_date").isNotNull())
    for key in keys:
        versions = versions.where(F.col(key).isNotNull())
    if tombstones == "ignore":
        versions = not_deleted(versions)
    quoted = lambda c: F.col(f"`{c}`")
    asked = requests.select(
        *keys, F.col("instant").cast("timestamp").alias("_at"), F.lit(None).cast("string").alias("_tie"), F.struct(*[quoted(c) for c in requests.columns]).alias("_request"))
    known = versions.select(
        *keys, F.col("system_date").alias("_at"), F.col("ingest_id").alias("_tie"), F.struct(*[quoted(c) for c in added]).alias("_version"))
    hour = F.coalesce(F.floor(F.unix_seconds("_at") / 3600), F.lit(2**62))
    rows = known.unionByName(asked, allowMissingColumns=True).withColumn("_hour", hour)
    # a version of the very instant counts; a missing instant comes last
    order = [F.asc_nulls_last("_at"), F.col("_request").isNotNull(), F.asc("_tie")]
    inside = Window.partitionBy(*keys, "_hour").orderBy(*order)
    placed = rows.withColumn("_found", F.last("_version", ignorenulls=True).over(inside)).where("_request IS NOT NULL")
    # the newest version of each cell, and for each cell with requests the newest of the cells before it
    newest_of = F.max_by("_version", F.when(F.col("_version").isNotNull(), F.struct("_at", "_tie")))
    cells = rows.groupBy(*keys, "_hour").agg(newest_of.alias("_newest"), F.max(F.col("_request").isNotNull()).alias("_asked"))
    before_it = Window.partitionBy(*keys).orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_handed", F.last("_newest", ignorenulls=True).over(before_it)).where("_asked")
    named = cells.select(*[F.col(k).alias(f"_cell_{k}") for k in keys], F.col("_hour").alias("_cell_hour"), "_handed")
    same = F.col("_hour") == F.col("_cell_hour")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_cell_{key}"))
    found = placed.join(named, same, "left").select("_request", F.coalesce("_found", "_handed").alias("_version"))
    if tombstones == "apply":
        found = found.withColumn("_version", F.when(~F.col("_version.deleted").eqNullSafe(F.lit(True)), F.col("_version")))
    return found.select(
        *[F.col(f"_request.`{c}`").alias(c) for c in requests.columns if c not in added], *[F.col(f"_version.`{c}`").alias(c) for c in added])


def tool_series(facts: DataFrame, asset_id=None, source_id=None, start=None, end=None, limit: int | None = None) -> DataFrame:
    """Per (asset, source): newest version per date, end exclusive, markers may win."""
    rows = where_equal(facts, asset_id=asset_id, data_source_id=source_id)
    latest = pick_latest(business_range(rows, start, end, end_inclusive=False), KEY, "include")
    if limit is None:
        return latest
    return top_versions(latest, ["asset_id", "data_source_id"], [F.desc("business_date")], limit)


def common_indicators(
    facts: DataFrame, sources: DataFrame, asset_id=None, source_id=None, start=None, end=None,
    as_of_instant=None, limit: int | None = None, include_deleted: bool = False,
) -> DataFrame:
    """Latest versions with the common indicators as columns and the vendor of their source."""
    rows = where_equal(facts, asset_id=asset_id, data_source_id=source_id)
    rows = as_of(business_range(rows, start, end), as_of_instant)
    if not include_deleted:
        rows = not_deleted(rows)
    # narrow before the pick, so that only these columns are shuffled
    narrow = rows.select(
        *KEY, "system_date", "ingest_id", *(metric(rows, m).alias(m) for m in COMMON_INDICATORS)
    )
    latest = top_versions(narrow, KEY, newest()).drop("ingest_id")
    order = [F.asc("asset_id"), F.asc("data_source_id"), F.desc("business_date")]
    if limit is None:
        return with_vendor(latest, sources)
    # a source has one row, so the cut comes before the join
    return with_vendor(page(latest, *order, limit=limit), sources).orderBy(*order)


def with_vendor(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Left join of the vendor columns; rows of unknown sources stay.

    No broadcast hint: the source table grows with the feeds, so the size check of
    ``autoBroadcastJoinThreshold`` decides, at plan time and again in AQE.
    """
    vendor = sources.select("data_source_id", "vendor_id", "vendor_name", "vendor_description")
    return rows.join(vendor, "data_source_id", "left")


def find_latest(facts: DataFrame, asset_id: str | None = None, source_id: str | None = None) -> DataFrame:
    """The newest record of each (asset, source), markers included."""
    rows = where_equal(facts, asset_id=asset_id, data_source_id=source_id)
    return top_versions(rows, ["asset_id", "data_source_id"], newest())


def find_all(facts: DataFrame, asset_id: str | None = None, source_id: str | None = None) -> DataFrame:
    """Every version of one (asset, source), newest first; of all of them, unsorted, without ids."""
    rows = where_equal(facts, asset_id=asset_id, data_source_id=source_id)
    return rows if asset_id is None and source_id is None else rows.orderBy("asset_id", "data_source_id", *newest())


def _lineage(rows: DataFrame, key: str, wanted: str | None, limit: int | None) -> DataFrame:
    """The versions of a key, newest first for one wanted key; of each key the first ``limit``, if it is given.

    The cut is made by (key, month) first, so that a hot key reaches its last task as ``limit`` rows of each of its months
    and not of each task of the scan.
    """
    if limit is not None:
        rows = top_versions(rows.withColumn("_month", F.trunc("business_date", "month")), [key, "_month"], latest_day(), limit)
        rows = top_versions(rows.drop("_month"), [key], latest_day(), limit)
    return rows if wanted is None else rows.orderBy(*latest_day())


def asset_lineage(facts: DataFrame, asset_id=None, source_id=None, limit: int | None = None) -> DataFrame:
    """Every version of each asset, markers included, or the newest ``limit``."""
    return _lineage(where_equal(facts, asset_id=asset_id, data_source_id=source_id), "asset_id", asset_id, limit)


def source_lineage(facts: DataFrame, source_id=None, limit: int | None = None) -> DataFrame:
    """Every version of each source, markers included, or the newest ``limit``."""
    return _lineage(where_equal(facts, data_source_id=source_id), "data_source_id", source_id, limit)


def series_between(facts: DataFrame, assets: DataFrame, start: str, end: str, asset_id: str | None = None) -> DataFrame:
    """Versions of known assets in a date range; reversed bounds are swapped. One asset comes newest version first."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    inside = F.col("business_date").between(F.least(first, last), F.greatest(first, last))
    rows = where_in(where_equal(facts, asset_id=asset_id).where(inside), "asset_id", assets)
    return rows if asset_id is None else rows.orderBy(*newest())


def latest_year(totals: DataFrame) -> DataFrame:
    """The most recent yearly row of each asset."""
    return top_versions(totals, ["asset_id"], [F.desc("business_date_year")])
