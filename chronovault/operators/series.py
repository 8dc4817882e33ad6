"""Daily series: calendars, gap filling, missing dates, nearest records, backfill."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed
from ..functions.identity import ingest_id
from ..functions.metrics import derive_metrics, metric, metric_keys, omit_metrics, provenance
from ..functions.text import asset_class, provider
from .filters import business_range, where_equal, where_in
from .versions import newest, latest_by_asset, top_versions


def check_range(start: str | date, end: str | date) -> tuple[date, date]:
    first, last = (d if isinstance(d, date) else date.fromisoformat(d) for d in (start, end))
    if last < first:
        raise ValueError("end date must be on or after start date")
    return first, last


def calendar(assets: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """One row per asset and day of the inclusive range. ``assets`` has distinct asset ids."""
    first, last = check_range(start, end)
    days = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))
    return assets.select("asset_id", F.explode(days).alias("business_date"))


# A request for assets: a table with asset_id, a list of ids, or all assets of the facts.
Assets = DataFrame | Sequence[str] | None


def _asset_list(facts: DataFrame, assets: Assets) -> tuple[DataFrame, DataFrame]:
    """(assets, facts of these assets): a list filters the scan, a table is a semi-join, None is no filter."""
    if assets is None:
        return facts.select("asset_id").where(F.col("asset_id").isNotNull()).distinct(), facts
    if isinstance(assets, DataFrame):
        return assets, where_in(facts, "asset_id", assets)
    listed = facts.sparkSession.createDataFrame([(a,) for a in dict.fromkeys(assets)], "asset_id string")
    return listed, where_in(facts, "asset_id", list(assets))


def gap_fill(
    facts: DataFrame, assets: Assets, start, end, source_id: str | None = None,
    limit: int | None = None, include_deleted: bool = False,
) -> DataFrame:
    """Exactly one row per asset and day with the daily metrics; days without data are null.

    The close-derived metrics fall back to the close where they are null. The version pick
    and the join share the (asset, date) partitioning.
    """
    assets, facts = _asset_list(facts, assets)
    narrow = facts.select(
        "asset_id", "data_source_id", "business_date", "system_date", "ingest_id", "deleted",
        *(metric(facts, m).alias(m) for m in fixed.DAILY_METRICS),
    )
    latest = latest_by_asset(
        narrow, source_id=source_id, start=start, end=end, limit=limit,
        tombstones="include" if include_deleted else "ignore",
    )
    filled = {m: F.coalesce(F.col(m), F.col("close_price")) for m in fixed.CLOSE_DERIVED}
    return calendar(assets, start, end).join(latest, ["asset_id", "business_date"], "left").select(
        "asset_id", "business_date", *(filled.get(m, F.col(m)).alias(m) for m in fixed.DAILY_METRICS)
    )


def missing_ranges(
    facts: DataFrame, assets: Assets, start, end, source_id: str | None = None
) -> DataFrame:
    """The gaps of the range without any row, as (asset_id, first_date, last_date, days), markers counting as rows.

    An asset's distinct dates, with the days around the range as fences, are islands; a gap lies between two
    neighbours more than a day apart. No calendar is built: rows follow the dates that exist and the gaps.
    Requested assets stand once in the result, however often they are asked for; a null asset has no dates.
    """
    first, last = check_range(start, end)
    assets, facts = _asset_list(facts, assets)
    existing = business_range(where_equal(facts, data_source_id=source_id), start, end).where("asset_id IS NOT NULL").select("asset_id", "business_date")
    fences = F.explode(F.array(F.date_sub(F.lit(first), 1), F.date_add(F.lit(last), 1)))
    fenced = assets.select("asset_id", fences.alias("business_date"))
    dates = existing.unionByName(fenced).distinct()
    following = F.lead("business_date").over(Window.partitionBy("asset_id").orderBy("business_date"))
    gaps = dates.withColumn("_next", following).where(F.datediff("_next", "business_date") > 1)
    return gaps.select(
        "asset_id", F.date_add("business_date", 1).alias("first_date"), F.date_sub("_next", 1).alias("last_date"),
        (F.datediff("_next", "business_date") - 1).alias("days"),
    )


def missing_dates(
    facts: DataFrame, assets: Assets, start, end, source_id: str | None = None
) -> DataFrame:
    """The (asset, date) pairs of the range without any row, markers counting as rows: the days of the gaps."""
    gaps = missing_ranges(facts, assets, start, end, source_id)
    return gaps.select("asset_id", F.explode(F.sequence("first_date", "last_date")).alias("business_date"))


def nearest_records(wanted: DataFrame, candidates: DataFrame, payload: Sequence[str]) -> DataFrame:
    """For each wanted (asset, date) the candidate of the asset with the closest date.

    Adds ``nearest_date`` and the payload columns; the earlier date wins a tie; all null for
    an asset without candidates. Candidates are first cut to one per (asset, date), the
    newest version, so an asset's window is bounded by the calendar whatever its rows.
    """
    keys = ["asset_id", "business_date"]
    daily = top_versions(candidates.where(F.col("business_date").isNotNull()), keys, newest()).select(
        *keys, F.struct(F.col("business_date").alias("nearest_date"), *payload).alias("_record")
    )
    marked = wanted.select(*keys).unionByName(daily, allowMissingColumns=True)
    is_wanted = F.col("_record").isNull()
    asset = Window.partitionBy("asset_id")
    # both frames end at the current row, so each is a running value, not a rescan
    back = F.last("_record", ignorenulls=True).over(asset.orderBy(F.asc("business_date"), is_wanted))
    ahead = F.last("_record", ignorenulls=True).over(asset.orderBy(F.desc("business_date"), is_wanted))
    placed = marked.withColumn("_back", back).withColumn("_ahead", ahead).where(is_wanted)
    gap_back = F.datediff("business_date", F.col("_back.nearest_date"))
    gap_ahead = F.datediff(F.col("_ahead.nearest_date"), "business_date")
    earlier = F.col("_ahead").isNull() | (gap_back <= gap_ahead)
    return placed.select(*keys, F.when(earlier, F.col("_back")).otherwise(F.col("_ahead")).alias("_nearest")).select(
        *keys, "_nearest.*"
    )


def backfill_source(asset: Column, nearest_source: Column, source_id: str | None) -> Column:
    """The requested source, else the nearest record's, else the class default."""
    default = provider(asset_class(asset))["source_identifier"]
    return F.coalesce(F.lit(source_id).cast("string"), nearest_source, default)


def backfill(
    facts: DataFrame, assets: Assets, start, end, source_id: str | None = None, omit: Sequence[str] = (),
    now: Column | None = None,
) -> DataFrame:
    """New fact rows for the missing dates, copied from the nearest record of the asset.

    Omitting comes before deriving, so an omitted derived metric comes back from the close.
    Feed the result to ``append_facts``.
    """
    wanted = missing_dates(facts, assets, start, end, source_id)
    _, candidates = _asset_list(facts, assets)
    nearest = nearest_records(wanted, candidates, ["data_source_id", "metrics", "attributes"])
    copied = F.coalesce(F.col("metrics"), F.create_map().cast("map<string,double>"))
    now = F.date_trunc("second", F.current_timestamp()) if now is None else now
    rows = nearest.select(
        "asset_id",
        backfill_source(F.col("asset_id"), F.col("data_source_id"), source_id).alias("data_source_id"),
        "business_date",
        now.alias("system_date"),
        omit_metrics(copied, omit).alias("metrics"),
        "attributes",
        provenance(
            source_name=F.lit(fixed.BACKFILL_SOURCE_NAME),
            query_parameters=F.create_map().cast("map<string,string>"),
            row_index=F.lit(0), captured_at=now, note=F.lit(fixed.BACKFILL_NOTE),
        ).alias("provenance"),
    ).withColumn("metrics", derive_metrics(F.col("metrics")))
    listed = F.when(F.size("attributes") > 0, F.col("attributes")).otherwise(metric_keys(F.col("metrics")))
    return rows.withColumns({
        "attributes": listed,
        "ingest_id": ingest_id(*(F.col(c) for c in ("asset_id", "data_source_id", "business_date", "metrics", "provenance"))),
        "deleted": F.lit(None).cast("boolean"),
    })


def backfill_status(assets: DataFrame, inserted: DataFrame) -> DataFrame:
    """Per asset ``ok`` with the number of inserted rows, or ``noop``."""
    counts = inserted.groupBy("asset_id").agg(F.count(F.lit(1)).alias("_n"))
    n = F.coalesce("_n", F.lit(0).cast("long"))
    return assets.select("asset_id").join(counts, "asset_id", "left").select(
        "asset_id", F.when(n > 0, "ok").otherwise("noop").alias("status"), n.alias("inserted")
    )
