"""Whole runs: ingest, analytics and the per-asset summary, each one job graph."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..session import materialise
from ..functions.text import asset_class, asset_metadata
from ..operators.deletes import asset_delete_markers, delete_markers, partition_markers
from ..operators.dimensions import asset_changes, deactivate_assets, fold_assets, fold_sources, source_changes
from ..operators.filters import where_in, where_not_in
from ..operators.series import backfill, backfill_status
from ..operators.statistics import linear_trends, yearly_totals
from ..operators.versions import latest_versions, latest_year
from ..sources.pages import ingest_status, prepare_ingest
from ..sources.tables import append_facts, append_rows, current_version, read_facts, read_table, replace_table
from .catalog import supported_assets


def table_paths(root: str) -> dict[str, str]:
    names = ["facts", "asset_changes", "source_changes", "totals", "regression_results", "quarantine", "ingest_log"]
    return {name: f"{root.rstrip('/')}/{name}" for name in names}


def store_batch(spark: SparkSession, batch: DataFrame, root: str, skip_unchanged: bool = False) -> None:
    """Facts, then the dimension changes they imply.

    Every step may run twice: facts are insert-if-absent, and folding the same change
    twice gives the same dimension row.
    """
    paths = table_paths(root)
    append_facts(spark, batch, paths["facts"], skip_unchanged)
    append_rows(asset_changes(batch), paths["asset_changes"])
    append_rows(source_changes(batch), paths["source_changes"])


def read_assets(spark: SparkSession, root: str) -> DataFrame:
    return fold_assets(read_table(spark, table_paths(root)["asset_changes"], schemas.ASSETS))


def read_sources(spark: SparkSession, root: str) -> DataFrame:
    return fold_sources(read_table(spark, table_paths(root)["source_changes"], schemas.SOURCES))


def compact_dimensions(spark: SparkSession, root: str) -> None:
    """Replaces the change logs by their folded rows. Run it while nothing is appended; of two that run at once, one fails."""
    paths = table_paths(root)
    for name, read in (("asset_changes", read_assets), ("source_changes", read_sources)):
        version = current_version(spark, paths[name])
        replace_table(materialise(spark, read(spark, root), name), paths[name], version)


def run_ingest(
    spark: SparkSession, pages: DataFrame, requested: DataFrame | None, root: str, omit: Sequence[str] = (),
    max_pages: int | None = None, max_rows: int | None = None, reasons: bool = False, fallback_on_failure: bool = False,
) -> DataFrame:
    """Ingests landed pages for the requested assets and returns a status row per asset, with a reason for errors if asked for.

    Without a request, all supported assets are ingested. All landed rows count unless a cap is given. A row that says what the
    version before it says is no new version. The batch is written once and then read by each sink. Unreadable pages go to the
    quarantine and make their asset an error; counts taken during the writes go to the log.
    """
    requested = supported_assets(spark) if requested is None else requested
    run = prepare_ingest(pages, requested, omit, max_pages, max_rows, fallback_on_failure=fallback_on_failure)
    written = Observation()
    # a template row has no page
    counted = run.batch.observe(
        written, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("provenance.page_number").isNull()).alias("template_rows"),
        F.count_if(F.col("business_date").isNull()).alias("undated_rows"))
    batch = materialise(spark, counted, "ingest")
    store_batch(spark, batch, root, skip_unchanged=True)
    if run.counts.get["unreadable_pages"]:
        quarantine(spark, run.unreadable, root)
    log = {"run_at": datetime.now(timezone.utc).replace(microsecond=0), **{n: c or 0 for n, c in (run.counts.get | written.get).items()}}
    append_rows(spark.createDataFrame([tuple(log[n] for n in schemas.INGEST_LOG.names)], schemas.INGEST_LOG), table_paths(root)["ingest_log"])
    return ingest_status(requested, batch, run.failures if reasons else None)


def quarantine(spark: SparkSession, unreadable: DataFrame, root: str) -> None:
    """Adds unreadable pages to the quarantine; a landing that it has already is not added again."""
    path, key = table_paths(root)["quarantine"], ["asset_id", "page_number", "landed_at", "landed_path"]
    held = read_table(spark, path, schemas.QUARANTINE).select(*[F.col(c).alias(f"_{c}") for c in key])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    append_rows(unreadable.select(*schemas.QUARANTINE.names).join(held, same, "left_anti"), path)


def recent_records(facts: DataFrame, asset_ids: Sequence[str] | DataFrame | None) -> DataFrame:
    return latest_versions(facts, asset_ids)


def run_backfill(
    spark: SparkSession, root: str, assets: DataFrame, start, end, source_id: str | None = None, omit: Sequence[str] = ()
) -> DataFrame:
    """Fills the missing dates of the assets in the store and returns a status row per asset."""
    facts = read_facts(spark, table_paths(root)["facts"])
    made = materialise(spark, backfill(facts, assets, start, end, source_id, omit), "backfill")
    attributes_only = F.struct(*(
        (F.col("attributes") if f.name == "attributes" else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schemas.SOURCE_METADATA.fields
    ))
    described = made.withColumns({
        "asset_metadata": asset_metadata(F.col("asset_id"), asset_class(F.col("asset_id"))),
        "source_metadata": attributes_only,
    })
    store_batch(spark, described, root)
    return backfill_status(assets, made)


def mark_rows_deleted(spark: SparkSession, root: str, keys: DataFrame, now: datetime | None = None, bulk: bool = False) -> None:
    """Appends a marker per (asset, source, business date) of ``keys``, or per partition key for ``bulk``.

    Each call is a version of its own: a key that was written again after a delete can be deleted again.
    """
    at = F.lit(now or datetime.now(timezone.utc).replace(microsecond=0)).cast("timestamp")
    markers = partition_markers(keys, at) if bulk else delete_markers(keys, at)
    append_facts(spark, materialise(spark, markers, "markers"), table_paths(root)["facts"])


def mark_assets_deleted(spark: SparkSession, root: str, requests: DataFrame, now: datetime | None = None) -> None:
    """Appends a marker per requested asset, once, and logs known assets as inactive."""
    paths = table_paths(root)
    at = F.lit(now or datetime.now(timezone.utc).replace(microsecond=0)).cast("timestamp")
    markers = materialise(spark, asset_delete_markers(requests, at), "markers")
    known = read_assets(spark, root).join(markers.select("asset_id").distinct(), "asset_id", "left_semi")
    changes = materialise(spark, deactivate_assets(known, markers, at).select(*schemas.ASSETS.names), "inactive")
    append_facts(spark, markers, paths["facts"])
    append_rows(changes, paths["asset_changes"])


def run_analytics(
    spark: SparkSession, root: str, asset_ids=None, descriptive: bool = True, predictive: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Recomputes the stored totals and trends, and returns both as stored afterwards.

    A run for some assets replaces their rows and leaves those of all others alone. Results are complete before they replace
    anything. A run that finds nothing to total, or nothing to fit, leaves the stored results as they were.
    """
    paths = table_paths(root)
    facts = read_facts(spark, paths["facts"])
    listed = asset_ids if asset_ids is None or isinstance(asset_ids, DataFrame) else list(asset_ids)

    def renew(fresh: DataFrame, name: str, schema) -> None:
        fresh = materialise(spark, fresh, name)
        if fresh.isEmpty():
            return
        version = current_version(spark, paths[name])
        if listed is not None:
            others = where_not_in(read_table(spark, paths[name], schema), "asset_id", listed)
            fresh = materialise(spark, others.select(*schema.names).unionByName(fresh.select(*schema.names)), name)
        replace_table(fresh, paths[name], version)

    if descriptive:
        renew(yearly_totals(facts, listed), "totals", schemas.TOTALS)
    if predictive:
        renew(linear_trends(facts, listed), "regression_results", schemas.REGRESSION_RESULTS)
    return (
        read_table(spark, paths["totals"], schemas.TOTALS),
        read_table(spark, paths["regression_results"], schemas.REGRESSION_RESULTS),
    )


def run_summary(totals: DataFrame, predictions: DataFrame, asset_ids=None) -> DataFrame:
    """Per requested asset: its latest year, the rows of that year, and its predicted close."""
    years = latest_year(where_in(totals, "asset_id", asset_ids)).select(
        "asset_id", "business_date_year", "record_count"
    )
    predicted = where_in(predictions, "asset_id", asset_ids).select("asset_id", "predicted_next_close_price")
    return years.join(predicted, "asset_id", "full")


def asset_frame(spark: SparkSession, symbols: Sequence[str]) -> DataFrame:
    """A request list as a DataFrame."""
    return spark.createDataFrame([(s,) for s in symbols], "asset_id string").where(F.col("asset_id") != "")
