"""Idempotent inserts, dimension upserts, markers, migration, export, JSON."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from .. import schemas
from ..functions.identity import ingest_id
from ..functions.metrics import provenance
from ..functions.text import symbol
from ..operators import deletes, dimensions
from ..operators.statistics import yearly_totals
from ..operators.versions import latest_versions
from ..plans import runs
from ..session import scratch_path
from ..sources import tables
from . import views as v
from .aggregates import rounded_totals
from .expressions import LEGACY_SQL, legacy_dates
from .registry import ORACLES, ntz, oracle, query


def _now():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


@query("snk1_insert_if_absent", oracle("facts", body="""
    SELECT asset_id, business_date, ingest_id FROM facts WHERE business_date >= DATE '2024-01-16'"""))
def snk1(spark, sf):
    """Everything arrives twice, and the first half of the month is stored already."""
    facts = v.facts(spark, sf)
    stored = facts.where(F.col("business_date") < F.lit("2024-01-16").cast("date"))
    batch = tables.require_ingest_id(facts.unionByName(facts))
    return tables.new_facts(batch, stored).select("asset_id", "business_date", "ingest_id")


def describe(facts):
    """Facts with asset and source metadata that changes over time and is missing at times."""
    k = F.col("event_id") % 10
    asset_metadata = F.struct(
        F.col("event_type").alias("asset_type"),
        F.when(k > 2, F.concat(F.lit("D"), k.cast("string"))).alias("description"),
        F.when(k % 2 == 0, F.lit("")).otherwise(F.concat(F.lit("R"), k.cast("string"))).alias("region"),
        F.lit(None).cast("string").alias("instrument_class"),
    )
    vendor = F.when(k % 3 > 0, F.concat(F.lit("V"), k.cast("string")))
    source_metadata = F.struct(
        F.concat(F.lit("Feed "), "asset_id").alias("display_name"),
        F.when(k > 4, F.col("event_type")).alias("description"),
        F.col("attributes"),
        vendor.alias("vendor_id"),
        F.when(k < 8, F.concat(F.lit("Vendor "), k.cast("string"))).alias("vendor_name"),
        F.lit(None).cast("string").alias("vendor_description"),
    )
    return facts.withColumns({"asset_metadata": asset_metadata, "source_metadata": source_metadata})


def _halves(spark, sf):
    rows = describe(v.facts(spark, sf))
    late = F.col("business_date") >= F.lit("2024-01-16").cast("date")
    return rows.where(~late), rows.where(late)


ASSET_DIM_SQL = """
    , latest AS (SELECT asset_id, min(system_date) AS first_seen, max(system_date) AS last_seen,
        max({'t': system_date, 'x': event_type}).x AS asset_type,
        max({'t': system_date, 'x': 'D' || event_id % 10}) FILTER (WHERE event_id % 10 > 2) AS d,
        max({'t': system_date, 'x': 'R' || event_id % 10}) FILTER (WHERE event_id % 10 % 2 = 1) AS r,
        max({'t': system_date, 'k': event_id % 10}) FILTER (WHERE event_id % 10 % 3 > 0) AS v,
        bool_or(deleted IS DISTINCT FROM TRUE) AS priced
      FROM facts GROUP BY 1)
    SELECT asset_id, first_seen, last_seen, TRUE AS active,
           CASE WHEN priced THEN 'close_price,volume' ELSE '' END AS supported_indicators,
           asset_type, d.x AS description, r.x AS region, CAST(NULL AS VARCHAR) AS instrument_class,
           'V' || v.k AS primary_vendor_id, CASE WHEN v.k < 8 THEN 'Vendor ' || v.k END AS primary_vendor_name,
           CAST(NULL AS VARCHAR) AS primary_vendor_description
    FROM latest"""


def shown_assets(assets):
    return assets.withColumns({
        "first_seen": F.col("first_seen").cast("timestamp_ntz"),
        "last_seen": F.col("last_seen").cast("timestamp_ntz"),
        "supported_indicators": F.array_join("supported_indicators", ","),
    })


@query("snk3_asset_dim", oracle("facts", body=ASSET_DIM_SQL))
def snk3(spark, sf):
    early, late = _halves(spark, sf)
    return shown_assets(dimensions.merge_assets(dimensions.merge_assets(None, early), late))


SOURCE_DIM_SQL = """
    , firsts AS (SELECT *, row_number() OVER (PARTITION BY data_source_id ORDER BY system_date, 'Feed ' || asset_id) AS r,
        min(system_date) OVER (PARTITION BY data_source_id) AS first_seen,
        max(system_date) OVER (PARTITION BY data_source_id) AS last_seen FROM facts)
    SELECT data_source_id, 'Feed ' || asset_id AS display_name, CASE WHEN event_id % 10 > 4 THEN event_type END AS description,
           CASE WHEN deleted THEN '' ELSE 'close_price,volume' END AS attributes,
           CASE WHEN event_id % 10 % 3 > 0 THEN 'V' || event_id % 10 END AS vendor_id,
           CASE WHEN event_id % 10 < 8 THEN 'Vendor ' || event_id % 10 END AS vendor_name,
           CAST(NULL AS VARCHAR) AS vendor_description,
           CASE WHEN deleted THEN '' ELSE 'close_price,volume' END AS supported_indicators,
           first_seen, last_seen, TRUE AS active
    FROM firsts WHERE r = 1"""


def shown_sources(sources):
    return sources.withColumns({
        "first_seen": F.col("first_seen").cast("timestamp_ntz"),
        "last_seen": F.col("last_seen").cast("timestamp_ntz"),
        "attributes": F.array_join("attributes", ","),
        "supported_indicators": F.array_join("supported_indicators", ","),
    })


@query("snk4_source_dim", oracle("facts", body=SOURCE_DIM_SQL))
def snk4(spark, sf):
    early, late = _halves(spark, sf)
    return shown_sources(dimensions.merge_sources(dimensions.merge_sources(None, early), late))


_MARKER = """CAST('2024-02-01' AS TIMESTAMP) AS system_date, '{reason}' AS reason, 'warehouse repository' AS source,
    TRUE AS deleted, CAST(0 AS INTEGER) AS metric_count, CAST(64 AS INTEGER) AS id_length"""


def _shown_markers(markers):
    return markers.select(
        "asset_id", "data_source_id", "business_date", ntz("system_date"),
        F.col("provenance.reason").alias("reason"), F.col("provenance.source").alias("source"), "deleted",
        F.size("metrics").alias("metric_count"), F.length("ingest_id").alias("id_length"),
    )


@query("snk5_delete_markers", oracle("facts", body=f"""
    SELECT DISTINCT asset_id, data_source_id, business_date, {_MARKER.format(reason='soft delete marker')} FROM facts"""))
def snk5(spark, sf):
    keys = v.facts(spark, sf).select("asset_id", "data_source_id", "business_date").distinct()
    return _shown_markers(deletes.delete_markers(keys, _now()))


@query("snk6_partition_markers", oracle("facts", body=f"""
    SELECT DISTINCT asset_id, data_source_id, CAST(NULL AS DATE) AS business_date,
           {_MARKER.format(reason='bulk soft delete marker')} FROM facts"""))
def snk6(spark, sf):
    keys = v.facts(spark, sf).select("asset_id", "data_source_id").distinct()
    return _shown_markers(deletes.partition_markers(keys, _now()))


def _delete_requests(spark, sf):
    """Every asset with an error event is asked to be deleted, twice, plus one unknown asset each."""
    facts = v.facts(spark, sf)
    marked = facts.where(F.col("deleted")).select(F.lower("asset_id").alias("asset_id")).distinct()
    return marked.unionByName(marked).unionByName(marked.select(F.concat(F.lit("x"), "asset_id").alias("asset_id")))


@query("snk7_mark_deleted", oracle("facts", "assets", body="""
    , asked AS (SELECT DISTINCT asset_id FROM facts WHERE deleted),
    markers AS (SELECT asset_id FROM asked UNION ALL SELECT 'X' || asset_id FROM asked)
    SELECT asset_id, 'SYSTEM.DELETE' AS data_source_id, DATE '2024-02-01' AS business_date,
           CASE WHEN asset_id IN (SELECT asset_id FROM assets) THEN FALSE END AS active,
           CASE WHEN asset_id IN (SELECT asset_id FROM assets) THEN TIMESTAMP '2024-02-01 00:00:00' END AS last_seen
    FROM markers"""))
def snk7(spark, sf):
    requests = _delete_requests(spark, sf)
    markers = deletes.asset_delete_markers(requests, _now())
    fresh = tables.new_facts(markers, v.facts(spark, sf).select("ingest_id"))
    dimension = v.assets(spark, sf).withColumns({
        "active": F.lit(True), "last_seen": F.lit("2024-01-01").cast("timestamp"),
    })
    named = requests.select(symbol(F.col("asset_id")).alias("asset_id"))
    after = dimensions.deactivate_assets(dimension, named, _now()).select("asset_id", "active", ntz("last_seen"))
    return fresh.select("asset_id", "data_source_id", "business_date").join(after, "asset_id", "left")


@query("snk8_overwrite", ORACLES["agg1_yearly_totals"])
def snk8(spark, sf):
    """Writes the totals table, replaces it, and reads it back."""
    totals = yearly_totals(v.facts_l(spark, sf))
    path = scratch_path(spark, "totals")
    tables.replace_table(totals.where(F.col("record_count") > 3), path)
    tables.replace_table(totals, path)
    return rounded_totals(tables.read_table(spark, path, totals.schema))


@query("snk9_migrate_dates", f"""
    SELECT CASE WHEN system_date IS NULL THEN 'unparseable' ELSE 'migrated' END AS status, COUNT(*) AS "rows",
           max(system_date) AS newest FROM ({LEGACY_SQL}) GROUP BY 1""")
def snk9(spark, sf):
    migrated = tables.migrate_system_dates(legacy_dates(spark, sf))
    newest = migrated.groupBy("status").agg(F.max("system_date").cast("timestamp_ntz").alias("newest"))
    return tables.migration_report(migrated).join(newest, "status")


@query("snk10_json", oracle("facts", body="""
    SELECT asset_id, '{"asset_id":"' || asset_id || '","business_date":"' || business_date || '","system_date":"'
           || strftime(system_date, '%Y-%m-%dT%H:%M:%SZ') || '","close_price":' || coalesce(CAST(close_price AS VARCHAR), 'null')
           || '}' AS json
    FROM facts"""))
def snk10(spark, sf):
    rows = v.facts(spark, sf).select(
        "asset_id", "business_date", "system_date", "close_price", F.col("event_id").alias("_id")
    )
    return tables.as_json(rows).select(F.get_json_object("json", "$.asset_id").alias("asset_id"), "json")


@query("snk11_export_window", oracle("facts", body="""
    SELECT DATE '2024-01-06' AS start_date, DATE '2024-01-25' AS end_date, COUNT(DISTINCT asset_id) AS asset_count,
           COUNT(*) AS record_count
    FROM facts WHERE business_date BETWEEN DATE '2024-01-06' AND DATE '2024-01-25'"""))
def snk11(spark, sf):
    return tables.export_summary(v.facts(spark, sf), "2024-01-25", 20)


@query("snk11_export_rows", oracle("facts", body="""
    SELECT asset_id, business_date, system_date, ingest_id, close_price FROM facts
    WHERE business_date BETWEEN DATE '2024-01-06' AND DATE '2024-01-25'"""))
def snk11_rows(spark, sf):
    rows = tables.export_window(v.facts(spark, sf), "2024-01-25", 20)
    return rows.select("asset_id", "business_date", ntz("system_date"), "ingest_id", "close_price")


def _price_day(spark, sf):
    """One price for each (asset, date) with any, as keys of a source."""
    priced = v.facts(spark, sf).where(F.col("close_price").isNotNull())
    return priced.groupBy("asset_id", "business_date").agg(F.max("close_price").alias("close_price")).withColumn("data_source_id", F.lit("S"))


def _landing(prices, hour, change):
    """The prices as facts of a landing at an hour of 2024-02-01, changed by an amount."""
    at = F.lit(f"2024-02-01 {hour:02d}:00:00").cast("timestamp")
    metrics = F.create_map(F.lit("close_price"), F.col("close_price") + change)
    described = prices.withColumns({"metrics": metrics, "provenance": provenance(source_name=F.lit("feed"), row_index=F.lit(hour), captured_at=at)})
    return described.withColumns({
        "system_date": at, "attributes": F.array(F.lit("close_price")), "deleted": F.lit(None).cast("boolean"),
        "ingest_id": ingest_id(*(F.col(c) for c in ("asset_id", "data_source_id", "business_date", "metrics", "provenance")), at),
    }).select(*schemas.FACTS.names)


_PRICES = "priced AS (SELECT asset_id, business_date, max(close_price) AS close_price FROM facts WHERE close_price IS NOT NULL GROUP BY 1, 2)"


@query("snk1_reverted_price", oracle("facts", body=f"""
    , {_PRICES} SELECT asset_id, business_date, close_price, CAST(3 AS BIGINT) AS versions FROM priced"""))
def snk1_reverted(spark, sf):
    """A price, another one, the first one again, each landed twice, then landed unchanged: three versions, the first price is the latest."""
    path, prices = scratch_path(spark, "facts"), _price_day(spark, sf)
    for hour, change in ((1, 0.0), (2, 5.0), (2, 5.0), (3, 0.0), (3, 0.0), (4, 0.0)):
        tables.append_facts(spark, _landing(prices, hour, change), path, skip_unchanged=True)
    stored = tables.read_facts(spark, path)
    counts = stored.groupBy("asset_id", "business_date").agg(F.count("*").alias("versions"))
    latest = latest_versions(stored).select("asset_id", "business_date", "close_price")
    return latest.join(counts, ["asset_id", "business_date"])


@query("snk5_delete_twice", oracle("facts", body=f"""
    , {_PRICES} SELECT asset_id, business_date, CAST(2 AS BIGINT) AS markers, FALSE AS visible FROM priced"""))
def snk5_twice(spark, sf):
    """A price is stored, deleted, stored anew and deleted again, through the store."""
    root, prices = scratch_path(spark, "warehouse"), _price_day(spark, sf)
    path = runs.table_paths(root)["facts"]
    for hour in (1, 3):
        tables.append_facts(spark, _landing(prices, hour, float(hour)), path)
        runs.mark_rows_deleted(spark, root, prices, datetime(2024, 2, 1, hour + 1, tzinfo=timezone.utc))
    stored = tables.read_facts(spark, path)
    visible = latest_versions(stored, tombstones="apply").select("asset_id", "business_date", F.lit(True).alias("_seen"))
    counts = stored.groupBy("asset_id", "business_date").agg(F.count(F.when(F.col("deleted"), 1)).alias("markers"))
    return counts.join(visible, ["asset_id", "business_date"], "left").select(
        "asset_id", "business_date", "markers", F.coalesce("_seen", F.lit(False)).alias("visible")
    )


@query("set1_union", oracle("facts_l", "assets_l", body="""
    SELECT asset_id FROM facts_l UNION SELECT asset_id FROM assets_l"""))
def set1(spark, sf):
    union = v.facts_l(spark, sf).select("asset_id").unionByName(v.assets_l(spark, sf).select("asset_id"))
    return union.distinct().orderBy("asset_id")
