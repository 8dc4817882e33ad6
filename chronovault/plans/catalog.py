"""Catalog and composite read queries.

A query about one asset, source or vendor takes its id; left out, it answers for all of
them in one job, without a global sort. Histories and lists of sources are rows, never one
nested value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.text import number_text, symbol
from ..operators.dimensions import union_attributes
from ..operators.filters import page, present, where_equal, where_in
from ..operators.versions import (
    common_indicators, latest_by_asset, latest_day, latest_year, newest, tool_series, top_versions,
)


def _sorted_for(rows: DataFrame, wanted: str | None, *order) -> DataFrame:
    """In order for one wanted id; unsorted for all ids, where order would cost a shuffle of everything."""
    return rows if wanted is None else rows.orderBy(*order)


def list_assets(assets: DataFrame, limit: int | None = None, offset: int = 0, after: str | None = None) -> DataFrame:
    return assets.orderBy("asset_id") if limit is None else page(assets, "asset_id", limit=limit, offset=offset, after=after)


def list_sources(sources: DataFrame, limit: int | None = None, offset: int = 0, after: str | None = None) -> DataFrame:
    if limit is None:
        return sources.orderBy("data_source_id")
    return page(sources, "data_source_id", limit=limit, offset=offset, after=after)


def count_rows(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("total_count"))


def get_asset(assets: DataFrame, asset_id: str) -> DataFrame:
    """The asset, whatever the letter case of the id; no row when unknown."""
    return assets.where(F.col("asset_id") == symbol(F.lit(asset_id)))


def get_assets(assets: DataFrame, requests: DataFrame) -> DataFrame:
    """The assets named by the ``asset_id`` texts of a request table."""
    return where_in(assets, "asset_id", requests.select(symbol(F.col("asset_id")).alias("asset_id")).distinct())


def get_source(sources: DataFrame, source_id: str) -> DataFrame:
    return where_equal(sources, data_source_id=source_id.strip())


def asset_history(assets: DataFrame, facts: DataFrame, asset_id: str | None = None) -> DataFrame:
    """Every version of the asset, newest first, with the asset's columns; none when it is unknown."""
    rows = where_equal(facts, asset_id=asset_id)
    described = assets.select("asset_id", "asset_type", F.col("description").alias("asset_description"), "instrument_class")
    return _sorted_for(rows.join(described, "asset_id"), asset_id, *newest())


def linked_sources(sources: DataFrame, facts: DataFrame, asset_id: str | None = None) -> DataFrame:
    """The sources each asset has rows from."""
    links = where_equal(facts, asset_id=asset_id).select("asset_id", "data_source_id").distinct()
    return _sorted_for(links.join(sources, "data_source_id"), asset_id, "data_source_id")


def asset_details(facts: DataFrame, asset_id: str | None = None, start=None, end=None, limit: int | None = None) -> DataFrame:
    """The latest version per date of an asset, the history part of its detail view.

    The asset row is ``get_asset`` and its sources are ``linked_sources``.
    """
    return latest_by_asset(facts, asset_id=asset_id, start=start, end=end, limit=limit)


def list_vendors(sources: DataFrame) -> DataFrame:
    columns = ["vendor_id", "vendor_name", "vendor_description"]
    return present(sources, "vendor_id").select(*columns).distinct().orderBy("vendor_name", "vendor_id")


def vendor_details(sources: DataFrame, vendor_id: str | None = None) -> DataFrame:
    """Sources of each vendor, with name and description taken from its first source by id.

    One row per (vendor, source), so that a vendor with a great many sources is no single value.
    """
    rows = present(where_equal(sources, vendor_id=vendor_id), "vendor_id")
    first = top_versions(rows, ["vendor_id"], [F.asc("data_source_id")]).select(
        "vendor_id", "vendor_name", "vendor_description"
    )
    described = rows.drop("vendor_name", "vendor_description").join(first, "vendor_id")
    return _sorted_for(described, vendor_id, "data_source_id")


def vendor_assets(sources: DataFrame, facts: DataFrame, assets: DataFrame, vendor_id: str | None = None) -> DataFrame:
    """Assets with rows from any source of the vendor, once per (vendor, asset).

    The facts are cut to distinct (source, asset) pairs before they meet anything else.
    """
    owned = present(where_equal(sources, vendor_id=vendor_id), "vendor_id").select("data_source_id", "vendor_id")
    held = facts.select("data_source_id", "asset_id").distinct()
    pairs = held.join(owned, "data_source_id").select("vendor_id", "asset_id").distinct()
    return _sorted_for(pairs.join(assets, "asset_id"), vendor_id, "asset_id")


def series_schema(facts: DataFrame, sources: DataFrame, asset_id=None, source_id=None) -> DataFrame:
    """Per (asset, source): the attribute list and date of its latest row, and the vendor."""
    rows = where_equal(facts, asset_id=asset_id, data_source_id=source_id)
    narrow = rows.select("asset_id", "data_source_id", "business_date", "system_date", "ingest_id", "attributes")
    sample = top_versions(narrow, ["asset_id", "data_source_id"], latest_day()).select(
        "asset_id", "data_source_id",
        F.col("attributes").alias("indicator_names"),
        F.col("business_date").alias("sample_business_date"),
        F.col("attributes").alias("sample_attributes"),
    )
    described = sample.join(
        sources.select(
            "data_source_id", "vendor_id", "vendor_name", "vendor_description",
            F.col("attributes").alias("source_attributes"),
        ),
        "data_source_id", "left",
    )
    return _sorted_for(described, asset_id or source_id, "asset_id", "data_source_id")


def asset_indicators(assets: DataFrame, sources: DataFrame, facts: DataFrame, asset_id: str | None = None) -> DataFrame:
    """Asset columns with its indicators and vendor, one row per linked source (null without one)."""
    known = where_equal(assets, asset_id=asset_id).select(
        "asset_id", F.col("supported_indicators").alias("indicator_schema"),
        "primary_vendor_id", "primary_vendor_name", "primary_vendor_description",
    )
    linked = linked_sources(sources, facts, asset_id).select(
        "asset_id", F.col("data_source_id").alias("linked_source_id"), F.col("display_name").alias("linked_source_name")
    )
    return known.join(linked, "asset_id", "left")


def instrument_indicators(facts: DataFrame, sources: DataFrame, limit: int | None = None) -> DataFrame:
    return common_indicators(facts, sources, limit=limit)


def analytics_summary(totals: DataFrame) -> DataFrame:
    return totals.orderBy("asset_id", "business_date_year")


def market_predictions(predictions: DataFrame) -> DataFrame:
    return predictions.orderBy("asset_id")


def asset_analytics(assets: DataFrame, totals: DataFrame, predictions: DataFrame, asset_id: str | None = None) -> DataFrame:
    """Yearly totals and the prediction of each asset, one row per year (null without totals)."""
    known = where_equal(assets, asset_id=asset_id).select("asset_id")
    joined = known.join(totals, "asset_id", "left").join(predictions.drop("calculation_time"), "asset_id", "left")
    return _sorted_for(joined, asset_id, "business_date_year")


def summary_texts(assets: DataFrame, totals: DataFrame, predictions: DataFrame) -> DataFrame:
    """The readable summary of each asset from its latest year and its prediction."""
    yearly = latest_year(totals).select(
        "asset_id",
        F.concat(
            F.lit("Latest year ("), F.col("business_date_year").cast("string"),
            F.lit("): avg "), number_text(F.round("average_close_price", 2)),
            F.lit(", min "), number_text(F.col("min_close_price")),
            F.lit(", max "), number_text(F.col("max_close_price")),
        ).alias("_year_line"),
    )
    predicted = predictions.select(
        "asset_id",
        F.concat(
            F.lit("Prediction: next close "), number_text(F.round("predicted_next_close_price", 2)),
            F.lit(" (r² "), number_text(F.round("r_squared", 4)), F.lit(")"),
        ).alias("_prediction_line"),
    )
    neither = F.col("_year_line").isNull() & F.col("_prediction_line").isNull()
    return (
        assets.select("asset_id").join(yearly, "asset_id", "left").join(predicted, "asset_id", "left")
        .select(
            "asset_id",
            F.concat_ws(
                "\n",
                F.concat(F.lit("Asset: "), F.col("asset_id")),
                "_year_line", "_prediction_line",
                F.when(neither, F.lit("No yearly summaries or predictions available.")),
            ).alias("summary"),
        )
    )


def series_data(facts: DataFrame, asset_id=None, source_id=None, start=None, end=None, limit: int | None = None) -> DataFrame:
    return tool_series(facts, asset_id, source_id, start, end, limit)


def supported_assets(spark) -> DataFrame:
    """The symbols of all classes, once each, sorted."""
    classes = [(cls, syms) for cls, syms in fixed.CLASS_SYMBOLS.items()]
    table = spark.createDataFrame(classes, "asset_class string, symbols array<string>")
    return table.select(F.explode("symbols").alias("asset_id")).distinct().orderBy("asset_id")


def attribute_catalog(facts: DataFrame) -> DataFrame:
    """All attribute names seen per asset."""
    return union_attributes(facts, "asset_id")
