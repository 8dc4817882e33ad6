"""Scans, filters and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import filters
from . import views as v
from .registry import ntz, oracle, query


@query("flt1_scan_filter_project", oracle("facts", body="""
    SELECT asset_id, business_date, system_date, event_type, close_price, volume, close_price * volume AS notional
    FROM facts WHERE data_source_id = 'S60' AND event_type IN ('click', 'purchase')
    ORDER BY business_date DESC, asset_id"""))
def flt1(spark, sf):
    rows = filters.where_equal(v.facts(spark, sf), data_source_id="S60", asset_id=None)
    rows = filters.where_in(rows, "event_type", ["click", "purchase"])
    return (
        rows.select(
            "asset_id", "data_source_id", "business_date", ntz("system_date"), "event_type", "close_price", "volume"
        )
        .withColumn("notional", F.col("close_price") * F.col("volume"))
        .drop("data_source_id")
        .orderBy(F.desc("business_date"), F.asc("asset_id"))
    )


@query("flt2_range_inclusive", oracle("facts_l", body="""
    SELECT asset_id, data_source_id, business_date, volume FROM facts_l
    WHERE business_date BETWEEN DATE '1996-02-01' AND DATE '1997-01-31'"""))
def flt2(spark, sf):
    rows = v.facts_l(spark, sf).select("asset_id", "data_source_id", "business_date", "volume")
    return filters.business_range(rows, "1996-02-01", "1997-01-31")


@query("flt3_range_exclusive", oracle("facts_l", body="""
    SELECT asset_id, data_source_id, business_date, volume FROM facts_l
    WHERE business_date >= DATE '1996-02-01' AND business_date < DATE '1997-01-31'"""))
def flt3(spark, sf):
    rows = v.facts_l(spark, sf).select("asset_id", "data_source_id", "business_date", "volume")
    return filters.business_range(rows, "1996-02-01", "1997-01-31", end_inclusive=False)


@query("flt4_not_deleted", oracle("live", body="SELECT asset_id, business_date, ingest_id FROM live"))
def flt4(spark, sf):
    return filters.not_deleted(v.facts(spark, sf)).select("asset_id", "business_date", "ingest_id")


@query("flt6_asof", oracle("facts", body="""
    SELECT asset_id, business_date, system_date, ingest_id FROM facts
    WHERE system_date <= TIMESTAMP '2024-01-20 12:00:00'"""))
def flt6(spark, sf):
    known = filters.as_of(v.facts(spark, sf), " 2024-01-20T12:00:00.9Z ")
    unfiltered = filters.as_of(known, "not an instant")
    return unfiltered.select("asset_id", "business_date", ntz("system_date"), "ingest_id")


@query("flt7_not_null", oracle("facts_l", body="""
    SELECT asset_id, business_date, close_price FROM facts_l WHERE close_price IS NOT NULL"""))
def flt7(spark, sf):
    return filters.present(v.facts_l(spark, sf), "close_price").select("asset_id", "business_date", "close_price")
