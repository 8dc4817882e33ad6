"""The catalog queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import statistics
from ..plans import catalog, runs
from ..session import scratch_path
from ..sources import tables
from . import joins, views as v
from .aggregates import compare, compare_sql, rounded_totals, rounded_trends
from .registry import ORACLES, oracle, query, r6, sql_r6
from .versions import WIN4_SQL, indicators_sql, latest_sql, shown, shown_indicators, tool_series

_ASSET = "asset_id, asset_type, description, instrument_class"
_SOURCE = "data_source_id, display_name, vendor_id, vendor_name, vendor_description"


@query("cat1_assets", oracle("assets_l", body=f"SELECT {_ASSET} FROM assets_l"))
def cat1(spark, sf):
    return catalog.list_assets(v.assets_l(spark, sf))


@query("cat2_asset_history", oracle("facts", "assets", body="""
    SELECT asset_id, ingest_id, business_date, system_date, close_price, asset_type, description AS asset_description,
           instrument_class FROM facts JOIN assets USING (asset_id)"""))
def cat2(spark, sf):
    history = catalog.asset_history(v.assets(spark, sf), v.facts(spark, sf))
    return history.select(
        "asset_id", "ingest_id", "business_date", F.col("system_date").cast("timestamp_ntz").alias("system_date"),
        "close_price", "asset_type", "asset_description", "instrument_class",
    )


@query("cat3_asset", oracle("assets", "facts", body=f"""
    SELECT {_ASSET} FROM assets WHERE asset_id IN (SELECT asset_id FROM facts WHERE event_type = 'signup')"""))
def cat3(spark, sf):
    signups = v.facts(spark, sf).where(F.col("event_type") == "signup")
    requests = signups.select(F.concat(F.lit("  "), F.lower("asset_id")).alias("asset_id"))
    return catalog.get_assets(v.assets(spark, sf), requests)


@query("cat4_asset_details", latest_sql(
    "live", "asset_id, business_date", "business_date BETWEEN DATE '2024-01-04' AND DATE '2024-01-24'"
))
def cat4(spark, sf):
    return shown(catalog.asset_details(v.facts(spark, sf), start="2024-01-04", end="2024-01-24"))


@query("cat5_sources", oracle("sources", body=f"SELECT {_SOURCE} FROM sources"))
def cat5(spark, sf):
    return catalog.list_sources(v.sources(spark, sf)).drop("attributes")


@query("cat6_vendors", oracle("sources", body="""
    SELECT vendor_id, vendor_name, vendor_description FROM sources GROUP BY ALL ORDER BY vendor_name"""))
def cat6(spark, sf):
    return catalog.list_vendors(v.sources(spark, sf))


query("cat7_vendor_details", joins.VENDOR_DETAILS_SQL)(joins.vendor_details)
query("cat8_vendor_assets", joins.VENDOR_ASSETS_SQL)(joins.vendor_assets)


@query("cat9_schema", oracle("facts", body="""
    SELECT asset_id, data_source_id, max(business_date) AS sample_business_date FROM facts GROUP BY 1, 2"""))
def cat9(spark, sf):
    schema = catalog.series_schema(v.facts(spark, sf), v.sources(spark, sf))
    return schema.select("asset_id", "data_source_id", "sample_business_date")


@query("cat10_asset_indicators", oracle("facts_l", "sources", "assets_l", body="""
    , links AS (SELECT DISTINCT asset_id, data_source_id, display_name FROM facts_l JOIN sources USING (data_source_id))
    SELECT asset_id, 'close_price' AS indicator_schema, data_source_id AS linked_source_id,
           display_name AS linked_source_name FROM assets_l LEFT JOIN links USING (asset_id)"""))
def cat10(spark, sf):
    none = F.lit(None).cast("string")
    assets = v.assets_l(spark, sf).withColumns({
        "supported_indicators": F.array(F.lit("close_price")), "primary_vendor_id": none,
        "primary_vendor_name": none, "primary_vendor_description": none,
    })
    found = catalog.asset_indicators(assets, v.sources(spark, sf), v.facts_l(spark, sf))
    return found.select(
        "asset_id", F.array_join("indicator_schema", ",").alias("indicator_schema"), "linked_source_id", "linked_source_name"
    )


@query("cat11_instrument_indicators", indicators_sql())
def cat11(spark, sf):
    return shown_indicators(catalog.instrument_indicators(v.facts(spark, sf), v.sources(spark, sf)))


@query("cat11_first_indicators", indicators_sql("LIMIT 100"))
def cat11_first(spark, sf):
    return shown_indicators(catalog.instrument_indicators(v.facts(spark, sf), v.sources(spark, sf), limit=100))


@query("cat2_one_asset", oracle("facts", "assets", body="""
    SELECT asset_id, ingest_id, business_date, system_date, close_price, asset_type, description AS asset_description,
           instrument_class FROM facts JOIN assets USING (asset_id) WHERE asset_id = 'U7'"""))
def cat2_one(spark, sf):
    history = catalog.asset_history(v.assets(spark, sf), v.facts(spark, sf), "U7")
    return history.select(
        "asset_id", "ingest_id", "business_date", F.col("system_date").cast("timestamp_ntz").alias("system_date"),
        "close_price", "asset_type", "asset_description", "instrument_class",
    )


@query("cat12_analytics_summary", ORACLES["agg1_yearly_totals"])
def cat12(spark, sf):
    return catalog.analytics_summary(rounded_totals(statistics.yearly_totals(v.facts_l(spark, sf))))


@query("cat13_predictions", ORACLES["mlr1_trend_ols"])
def cat13(spark, sf):
    return catalog.market_predictions(rounded_trends(statistics.linear_trends(v.facts(spark, sf))))


query("cat14_asset_analytics", joins.ANALYTICS_SQL)(joins.analytics)
query("cat15_series_data", WIN4_SQL)(tool_series)
query("cat16_compare_assets", compare_sql())(compare)


@query("cat17_run_summary", oracle("totals", "trends", "assets", body=f"""
    , years AS (SELECT asset_id, max(business_date_year) AS business_date_year,
                arg_max(record_count, business_date_year) AS record_count FROM totals GROUP BY 1)
    SELECT asset_id, business_date_year, record_count, {sql_r6('predicted_next_close_price')} AS predicted_next_close_price
    FROM years FULL JOIN trends USING (asset_id) WHERE asset_id IN (SELECT asset_id FROM assets)"""))
def cat17(spark, sf):
    facts = v.facts(spark, sf)
    summary = runs.run_summary(
        statistics.yearly_totals(facts), statistics.linear_trends(facts), v.assets(spark, sf)
    )
    return summary.withColumn("predicted_next_close_price", r6("predicted_next_close_price"))


@query("cat17_stored_summary", oracle("totals", "trends", "assets", body=f"""
    , years AS (SELECT asset_id, max(business_date_year) AS business_date_year,
                arg_max(record_count, business_date_year) AS record_count FROM totals GROUP BY 1)
    SELECT asset_id, business_date_year, record_count, {sql_r6('predicted_next_close_price')} AS predicted_next_close_price
    FROM years FULL JOIN trends USING (asset_id) WHERE asset_id IN (SELECT asset_id FROM assets)"""))
def cat17_stored(spark, sf):
    """The summary of totals and trends that a run stored, over stored facts."""
    root = scratch_path(spark, "warehouse")
    facts = v.facts(spark, sf).withColumn("provenance", F.lit(None).cast(tables.schemas.PROVENANCE))
    tables.append_facts(spark, facts, runs.table_paths(root)["facts"])
    summary = runs.run_summary(*runs.run_analytics(spark, root), v.assets(spark, sf))
    return summary.withColumn("predicted_next_close_price", r6("predicted_next_close_price"))


@query("cat18_analytics_run", oracle("totals", "trends", body=f"""
    SELECT asset_id, business_date_year, record_count, {sql_r6('average_close_price')} AS average_close_price,
           training_points, {sql_r6('calculated_trend_slope')} AS calculated_trend_slope
    FROM totals LEFT JOIN trends USING (asset_id)"""))
def cat18(spark, sf):
    """Stores the facts, runs the analytics on the stored table and reads the stored results."""
    root = scratch_path(spark, "warehouse")
    facts = v.facts(spark, sf).withColumn("provenance", F.lit(None).cast(tables.schemas.PROVENANCE))
    tables.append_facts(spark, facts, runs.table_paths(root)["facts"])
    totals, trends = runs.run_analytics(spark, root)
    return rounded_totals(totals).join(trends, "asset_id", "left").select(
        "asset_id", "business_date_year", "record_count", "average_close_price", "training_points",
        r6("calculated_trend_slope").alias("calculated_trend_slope"),
    )


@query("cat19_recent_records", latest_sql("live", "asset_id, data_source_id, business_date",
                                          "asset_id IN (SELECT 'U' || c_custkey FROM customer)"))
def cat19(spark, sf):
    return shown(runs.recent_records(v.facts(spark, sf), v.assets(spark, sf)))
