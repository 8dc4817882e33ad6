import pytest
from pyspark.sql import functions as F

from chronovault.operators import statistics
from chronovault.plans import catalog
from tests.helpers import facts, rows


@pytest.fixture(scope="module")
def world(spark):
    assets = spark.createDataFrame(
        [("A", "t", "Asset A", "c", ["x"], "V1", "Vendor", None), ("B", "t", "Asset B", "c", [], None, None, None), ("C", "t", "C", "c", [], None, None, None)],
        "asset_id string, asset_type string, description string, instrument_class string, supported_indicators array<string>, "
        "primary_vendor_id string, primary_vendor_name string, primary_vendor_description string",
    )
    sources = spark.createDataFrame(
        [("S1", "One", ["a"], "V1", "Vendor", "d"), ("S2", "Two", ["b"], "V1", "Vendor two", "d2"), ("S3", "Three", [], None, None, None)],
        "data_source_id string, display_name string, attributes array<string>, vendor_id string, vendor_name string, vendor_description string",
    )
    table = facts(spark, [
        ("A", "S1", "2024-01-01", "2024-01-01", {"close_price": 10.0}, "1"),
        ("A", "S2", "2024-01-02", "2024-01-02", {"close_price": 11.0}, "2"),
        ("A", "S1", "2024-01-03", "2024-01-03", {"close_price": 12.0, "volume": 1.0}, "3"),
        ("B", "S3", "2024-01-03", "2024-01-03", {}, "4", True),
    ])
    return assets, sources, table


def test_listings(spark, world):
    assets, sources, _ = world
    assert [r.asset_id for r in catalog.list_assets(assets, limit=1, offset=1).collect()] == ["B"]
    assert catalog.count_rows(assets).collect()[0][0] == 3
    assert rows(catalog.get_asset(assets, " a "), "asset_id") == [("A",)]
    assert catalog.get_asset(assets, "nope").count() == 0
    assert rows(catalog.get_source(sources, " S2"), "display_name") == [("Two",)]
    assert rows(catalog.list_sources(sources, limit=2), "data_source_id") == [("S1",), ("S2",)]
    assert len(rows(catalog.supported_assets(spark))) == 20


def test_vendors(spark, world):
    assets, sources, table = world
    assert rows(catalog.list_vendors(sources), "vendor_id", "vendor_name") == [("V1", "Vendor"), ("V1", "Vendor two")]
    assert rows(catalog.vendor_details(sources, "V1"), "data_source_id", "vendor_name") == [("S1", "Vendor"), ("S2", "Vendor")]
    assert rows(catalog.vendor_assets(sources, table, assets, "V1"), "asset_id") == [("A",)]
    assert catalog.vendor_details(sources, "V9").count() == 0


def test_linked_sources_and_schema(spark, world):
    assets, sources, table = world
    assert rows(catalog.linked_sources(sources, table, "A"), "data_source_id") == [("S1",), ("S2",)]
    assert rows(catalog.series_schema(table, sources), "asset_id", "data_source_id", "indicator_names", "vendor_id") == [
        ("A", "S1", ["close_price", "volume"], "V1"), ("A", "S2", ["close_price"], "V1"), ("B", "S3", [], None),
    ]
    found = catalog.asset_indicators(assets, sources, table)
    assert rows(found, "asset_id", "linked_source_id") == [("A", "S1"), ("A", "S2"), ("B", "S3"), ("C", None)]


def test_history_and_details(spark, world):
    assets, _, table = world
    assert [r.ingest_id for r in catalog.asset_history(assets, table, "A").collect()] == ["3", "2", "1"]
    assert rows(catalog.asset_details(table, "A", "2024-01-01", "2024-01-02"), "ingest_id") == [("1",), ("2",)]


def test_analytics_and_summary(spark, world):
    assets, _, table = world
    totals, trends = statistics.yearly_totals(table), statistics.linear_trends(table)
    joined = catalog.asset_analytics(assets, totals, trends)
    assert rows(joined, "asset_id", "record_count", "predicted_next_close_price") == [("A", 3, 13.0), ("B", None, None), ("C", None, None)]
    texts = dict(rows(catalog.summary_texts(assets, totals, trends)))
    assert texts["A"] == (
        "Asset: A\nLatest year (2024): avg 11.0, min 10.0, max 12.0\nPrediction: next close 13.0 (r² 1.0)"
    )
    assert texts["B"] == "Asset: B\nNo yearly summaries or predictions available."


def test_predictions_are_sorted(spark, world):
    _, _, table = world
    assert catalog.market_predictions(statistics.linear_trends(table)).columns[0] == "asset_id"
    assert catalog.analytics_summary(statistics.yearly_totals(table)).select(F.count("*")).collect()[0][0] == 1
