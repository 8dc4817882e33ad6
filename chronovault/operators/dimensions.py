"""Asset and source dimensions, maintained from fact batches.

A batch is first folded to its distinct metadata variants with min and max of the system
date: primitive buffers, hash aggregation, combined before the shuffle. What is left is
small (an asset or source has few variants), and the first- and last-writer rules run on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas

_ASSET_FIELDS = schemas.ASSET_METADATA.names
_VENDOR_FIELDS = ["vendor_id", "vendor_name", "vendor_description"]
_SOURCE_FIELDS = schemas.SOURCE_METADATA.names
_PRIMARY_VENDOR = {v: f"primary_{v}" for v in _VENDOR_FIELDS}


def _given(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def _latest(value: Column, when: Column) -> Column:
    """The latest value that satisfies ``when``; equal system dates fall back to the value itself."""
    return F.max(F.when(when, F.struct(F.col("last_seen"), value.alias("value"))))["value"]


def union_attributes(rows: DataFrame, key: str, column: str = "attributes") -> DataFrame:
    """Sorted set of all list entries per key.

    Distinct lists first, then a set per key that is merged before the shuffle: what is
    collected per key is its number of different attribute names, not its rows.
    """
    entries = rows.select(key, column).distinct().select(key, F.explode(column).alias("_entry"))
    return entries.groupBy(key).agg(F.array_sort(F.collect_set("_entry")).alias(column))


def _asset_variants(batch: DataFrame) -> DataFrame:
    """Distinct metadata of a batch of facts that carry asset_metadata and source_metadata."""
    return batch.groupBy(
        "asset_id",
        *(F.col(f"asset_metadata.{f}").alias(f) for f in _ASSET_FIELDS),
        *(F.col(f"source_metadata.{v}").alias(p) for v, p in _PRIMARY_VENDOR.items()),
        F.coalesce("source_metadata.attributes", F.array().cast("array<string>")).alias("supported_indicators"),
    ).agg(F.min("system_date").alias("first_seen"), F.max("system_date").alias("last_seen")).withColumn(
        "active", F.lit(True)
    )


def merge_assets(current: DataFrame | None, batch: DataFrame) -> DataFrame:
    """The asset dimension after a batch.

    first_seen is kept, last_seen moves, the asset becomes active, each metadata field is
    overwritten by the latest non-empty value, the vendor columns move together, and the
    indicators are united.
    """
    return fold_assets(_asset_variants(batch), current)


def fold_assets(changes: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """One row per asset from dimension rows, several per asset allowed."""
    if current is not None:
        changes = current.select(*schemas.ASSETS.names).unionByName(changes)
    vendor = F.struct(*_PRIMARY_VENDOR.values())
    folded = changes.groupBy("asset_id").agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.max(F.struct("last_seen", "active"))["active"].alias("active"),
        *(_latest(F.col(f), _given(F.col(f))).alias(f) for f in _ASSET_FIELDS),
        _latest(vendor, _given(F.col("primary_vendor_id"))).alias("_vendor"),
        # the rows are few variants of an asset's metadata, so the set of their lists is small
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("supported_indicators")))).alias("supported_indicators"),
    )
    return folded.select(
        *(
            F.col(f"_vendor.{c}").alias(c) if c in _PRIMARY_VENDOR.values()
            else F.coalesce(c, F.array().cast("array<string>")).alias(c) if c == "supported_indicators"
            else F.col(c)
            for c in schemas.ASSETS.names
        )
    )


def _source_variants(batch: DataFrame) -> DataFrame:
    metadata = {f: F.col(f"source_metadata.{f}") for f in _SOURCE_FIELDS}
    metadata["display_name"] = F.coalesce(metadata["display_name"], F.col("data_source_id"))
    metadata["attributes"] = F.coalesce(metadata["attributes"], F.array().cast("array<string>"))
    return batch.groupBy("data_source_id", *(c.alias(f) for f, c in metadata.items())).agg(
        F.min("system_date").alias("first_seen"), F.max("system_date").alias("last_seen")
    ).withColumns({"supported_indicators": F.col("attributes"), "active": F.lit(True)})


def merge_sources(current: DataFrame | None, batch: DataFrame) -> DataFrame:
    """The source dimension after a batch: the first writer's description stays for good."""
    return fold_sources(_source_variants(batch), current)


def fold_sources(changes: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """One row per source from dimension rows, several per source allowed."""
    changes = changes.withColumn("_new", F.lit(1))
    if current is not None:
        changes = current.select(*schemas.SOURCES.names).withColumn("_new", F.lit(0)).unionByName(changes)
    described = [*_SOURCE_FIELDS, "supported_indicators"]
    folded = changes.groupBy("data_source_id").agg(
        # what the table already holds precedes the batch; within it the earliest row wins
        F.min(F.struct("_new", "first_seen", *described)).alias("_first"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.max(F.struct("last_seen", "active"))["active"].alias("active"),
    )
    return folded.select(*(
        F.col(f"_first.{c}").alias(c) if c in described else F.col(c) for c in schemas.SOURCES.names
    ))


def asset_changes(batch: DataFrame) -> DataFrame:
    """The batch as asset dimension rows, to append to a change log and fold on read."""
    return fold_assets(_asset_variants(batch))


def source_changes(batch: DataFrame) -> DataFrame:
    """The batch as source dimension rows, to append to a change log and fold on read."""
    return fold_sources(_source_variants(batch))


def deactivate_assets(assets: DataFrame, requests: DataFrame, now: Column) -> DataFrame:
    """Existing assets named in the requests become inactive; unknown ones add nothing."""
    named = requests.select("asset_id").distinct().withColumn("_named", F.lit(True))
    return assets.join(named, "asset_id", "left").withColumns({
        "active": F.when(F.col("_named"), F.lit(False)).otherwise(F.col("active")),
        "last_seen": F.when(F.col("_named"), now).otherwise(F.col("last_seen")),
    }).drop("_named")
