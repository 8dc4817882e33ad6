"""Joins of facts, sources, assets and analytics."""

from __future__ import annotations

from ..operators import series, statistics, versions
from ..plans import catalog
from . import views as v
from .aggregates import rounded_totals, rounded_trends
from .registry import oracle, query, sql_r6

_VENDOR = "vendor_id, vendor_name, vendor_description"
LINKED_SQL = oracle("facts_l", "sources", body=f"""
    SELECT DISTINCT asset_id, data_source_id, display_name, {_VENDOR} FROM facts_l JOIN sources USING (data_source_id)""")
VENDOR_ASSETS_SQL = oracle("facts_l", "sources", "assets_l", body="""
    SELECT DISTINCT vendor_id, asset_id, asset_type, description, instrument_class
    FROM sources JOIN facts_l USING (data_source_id) JOIN assets_l USING (asset_id)""")
VENDOR_DETAILS_SQL = oracle("sources", body="""
    SELECT data_source_id, vendor_id, display_name,
           first_value(vendor_name) OVER w AS vendor_name, first_value(vendor_description) OVER w AS vendor_description
    FROM sources WINDOW w AS (PARTITION BY vendor_id ORDER BY data_source_id)""")
ANALYTICS_SQL = oracle("totals", "trends", "assets", body=f"""
    SELECT asset_id, business_date_year, record_count, min_close_price, max_close_price,
           {sql_r6('average_close_price')} AS average_close_price, training_points, last_known_close,
           {sql_r6('calculated_trend_slope')} AS calculated_trend_slope, {sql_r6('intercept')} AS intercept,
           {sql_r6('predicted_next_close_price')} AS predicted_next_close_price, {sql_r6('r_squared')} AS r_squared,
           last_business_date
    FROM assets LEFT JOIN totals USING (asset_id) LEFT JOIN trends USING (asset_id)""")


@query("jon1_facts_sources", oracle("facts_l", "sources", body=f"""
    SELECT asset_id, data_source_id, business_date, volume, {_VENDOR}
    FROM facts_l LEFT JOIN sources USING (data_source_id)"""))
def jon1(spark, sf):
    rows = v.facts_l(spark, sf).select("asset_id", "data_source_id", "business_date", "volume")
    return versions.with_vendor(rows, v.sources(spark, sf))


def linked(spark, sf):
    return catalog.linked_sources(v.sources(spark, sf), v.facts_l(spark, sf)).drop("attributes")


def vendor_assets(spark, sf):
    return catalog.vendor_assets(v.sources(spark, sf), v.facts_l(spark, sf), v.assets_l(spark, sf))


def vendor_details(spark, sf):
    return catalog.vendor_details(v.sources(spark, sf)).drop("attributes")


def analytics(spark, sf):
    facts = v.facts(spark, sf)
    return catalog.asset_analytics(
        v.assets(spark, sf),
        rounded_totals(statistics.yearly_totals(facts)),
        rounded_trends(statistics.linear_trends(facts)),
    )


query("jon3_linked_sources", LINKED_SQL)(linked)
query("jon4_vendor_assets", VENDOR_ASSETS_SQL)(vendor_assets)
query("jon5_vendor_details", VENDOR_DETAILS_SQL)(vendor_details)
query("jon6_asset_analytics", ANALYTICS_SQL)(analytics)


def spine_sql(start: str, end: str) -> str:
    return f"""spine AS (SELECT asset_id, CAST(d AS DATE) AS business_date FROM (SELECT DISTINCT asset_id FROM facts),
        generate_series(TIMESTAMP '{start}', TIMESTAMP '{end}', INTERVAL 1 DAY) g(d))"""


MISSING_SQL = "missing AS (SELECT * FROM spine WHERE (asset_id, business_date) NOT IN (SELECT (asset_id, business_date) FROM facts))"
NEAREST_SQL = """
    daily AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY asset_id, business_date
              ORDER BY system_date DESC, ingest_id DESC) AS v FROM facts) WHERE v = 1),
    nearest AS (SELECT * FROM (
        SELECT m.asset_id, m.business_date, d.business_date AS nearest_date, d.data_source_id, d.close_price, d.volume,
               d.deleted, row_number() OVER (PARTITION BY m.asset_id, m.business_date
               ORDER BY abs(d.business_date - m.business_date), d.business_date) AS n
        FROM missing m JOIN daily d ON d.asset_id = m.asset_id) WHERE n = 1)"""


@query("jon9_missing_dates", oracle("facts", body=f"""
    , {spine_sql('2024-01-01', '2024-01-30')}, {MISSING_SQL} SELECT * FROM missing"""))
def jon9(spark, sf):
    return series.missing_dates(v.facts(spark, sf), None, "2024-01-01", "2024-01-30")


@query("jon9_missing_ranges", oracle("facts", body="""
    , fenced AS (SELECT DISTINCT asset_id, business_date FROM facts WHERE business_date BETWEEN DATE '2023-12-20' AND DATE '2024-02-10'
                 UNION SELECT DISTINCT asset_id, unnest([DATE '2023-12-19', DATE '2024-02-11']) FROM facts),
    followed AS (SELECT *, lead(business_date) OVER (PARTITION BY asset_id ORDER BY business_date) AS next FROM fenced)
    SELECT asset_id, business_date + 1 AS first_date, next - 1 AS last_date, CAST(next - business_date - 1 AS INTEGER) AS days
    FROM followed WHERE next - business_date > 1"""))
def jon9_ranges(spark, sf):
    return series.missing_ranges(v.facts(spark, sf), None, "2023-12-20", "2024-02-10")


@query("jon10_nearest_date", oracle("facts", body=f"""
    , {spine_sql('2023-12-25', '2024-02-05')}, {MISSING_SQL}, {NEAREST_SQL}
    SELECT asset_id, business_date, nearest_date, data_source_id, close_price, volume FROM nearest"""))
def jon10(spark, sf):
    facts = v.facts(spark, sf)
    wanted = series.missing_dates(facts, None, "2023-12-25", "2024-02-05")
    return series.nearest_records(wanted, facts, ["data_source_id", "close_price", "volume"])
