"""Soft deletes: appended marker rows. Nothing is removed or rewritten."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed, schemas
from ..functions.identity import ingest_id
from ..functions.metrics import provenance
from ..functions.text import symbol


def _now(now: Column | None) -> Column:
    return F.date_trunc("second", F.current_timestamp() if now is None else now)


def _as_markers(keys: DataFrame, now: Column | None, reason: Column, once: bool = False) -> DataFrame:
    """Marker rows. Each is a version of its own, with its system date in the id, unless the request counts ``once``."""
    metrics = F.create_map().cast("map<string,double>")
    described = provenance(reason=reason, source=F.lit(fixed.DELETE_WRITER))
    identity = provenance(reason=reason) if once else described
    rows = keys.select(
        F.col("asset_id").cast("string").alias("asset_id"),
        F.col("data_source_id").cast("string").alias("data_source_id"),
        F.col("business_date").cast("date").alias("business_date"),
        _now(now).alias("system_date"),
        metrics.alias("metrics"),
        F.array().cast("array<string>").alias("attributes"),
        described.alias("provenance"),
        ingest_id(
            F.col("asset_id").cast("string"), F.col("data_source_id").cast("string"),
            F.col("business_date").cast("date"), metrics, identity, None if once else _now(now),
        ).alias("ingest_id"),
        F.lit(True).alias("deleted"),
    )
    return rows.select(*schemas.FACTS.names)


def delete_markers(keys: DataFrame, now: Column | None = None) -> DataFrame:
    """One marker per (asset, source, business date) row of ``keys``."""
    return _as_markers(keys, now, F.lit(fixed.DELETE_REASON))


def partition_markers(keys: DataFrame, now: Column | None = None) -> DataFrame:
    """One marker per partition key; a missing business date stays null."""
    if "business_date" not in keys.columns:
        keys = keys.withColumn("business_date", F.lit(None).cast("date"))
    return _as_markers(keys, now, F.lit(fixed.BULK_DELETE_REASON))


def asset_delete_markers(requests: DataFrame, now: Column | None = None) -> DataFrame:
    """Markers for whole assets.

    ``requests`` has asset_id and optionally effective_date, source_id and reason; the
    defaults are today, the delete source and the usual reason. The id depends on the
    request alone, so asking twice inserts once.
    """

    def optional(name: str, default: Column) -> Column:
        return F.coalesce(F.col(name), default) if name in requests.columns else default

    named = requests.select(
        symbol(F.col("asset_id")).alias("asset_id"),
        optional("source_id", F.lit(fixed.DELETE_SOURCE)).alias("data_source_id"),
        optional("effective_date", F.to_date(_now(now))).cast("date").alias("business_date"),
        optional("reason", F.lit(fixed.DELETE_REASON)).alias("_reason"),
    ).where(F.col("asset_id") != "")
    return _as_markers(named, now, F.col("_reason"), once=True)
