"""Explicit table schemas. Nothing in the package infers a schema from rows."""

from __future__ import annotations

from pyspark.sql import types as T

from .fixed import DAILY_METRICS

PROVENANCE = T.StructType([
    T.StructField("source_name", T.StringType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("query_parameters", T.MapType(T.StringType(), T.StringType())),
    T.StructField("page_number", T.IntegerType()),
    T.StructField("page_row_index", T.IntegerType()),
    T.StructField("row_index", T.IntegerType()),
    T.StructField("next_cursor_id", T.StringType()),
    T.StructField("columns", T.ArrayType(T.StringType())),
    T.StructField("captured_at", T.TimestampType()),
    T.StructField("note", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("source", T.StringType()),
])

FACTS = T.StructType([
    T.StructField("asset_id", T.StringType()),
    T.StructField("data_source_id", T.StringType()),
    T.StructField("business_date", T.DateType()),
    T.StructField("system_date", T.TimestampType()),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("attributes", T.ArrayType(T.StringType())),
    T.StructField("provenance", PROVENANCE),
    T.StructField("ingest_id", T.StringType()),
    T.StructField("deleted", T.BooleanType()),
])

# Metrics also stored as typed columns, because Parquet cannot prune a map by key.
PROMOTED_METRICS = [*DAILY_METRICS, "close"]

# The layout on disk: FACTS, the promoted metrics, and the partition column.
STORED_FACTS = T.StructType(
    FACTS.fields
    + [T.StructField(m, T.DoubleType()) for m in PROMOTED_METRICS]
    + [T.StructField("business_month", T.DateType())]
)

# The stored layout of a table from before the migration: system dates are text.
LEGACY_FACTS = T.StructType([
    *(T.StructField(f.name, T.StringType()) if f.name == "system_date" else f for f in FACTS.fields),
    T.StructField("business_month", T.DateType()),
])

MIGRATION_LOG = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("business_month", T.DateType()),
])

# Responses that are no pages, as they landed.
QUARANTINE = T.StructType([
    T.StructField("asset_id", T.StringType()),
    T.StructField("page_number", T.IntegerType()),
    T.StructField("landed_at", T.TimestampType()),
    T.StructField("landed_path", T.StringType()),
    T.StructField("problem", T.StringType()),
    T.StructField("body", T.StringType()),
])

# One row for each ingest run.
INGEST_LOG = T.StructType([
    T.StructField("run_at", T.TimestampType()),
    *(T.StructField(n, T.LongType()) for n in ("pages", "unreadable_pages", "landed_rows", "rows", "template_rows", "undated_rows")),
])

# Moments of an asset's closes in a month, see operators/moments.py.
MOMENTS = T.StructType([
    T.StructField("asset_id", T.StringType()),
    *(T.StructField(n, T.LongType()) for n in ("n", "returns", "total_count")),
    *(T.StructField(n, T.DoubleType()) for n in (
        "mean", "squares", "products", "least", "most", "first_close", "last_close", "mean_return", "return_squares",
        "total_mean", "total_least", "total_most",
    )),
    T.StructField("last_business_date", T.DateType()),
    T.StructField("business_month", T.DateType()),
])

ASSET_SKETCHES = T.StructType([
    T.StructField("business_date", T.DateType()),
    T.StructField("asset_sketch", T.BinaryType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("business_month", T.DateType()),
])

ASSETS = T.StructType([
    T.StructField("asset_id", T.StringType()),
    T.StructField("first_seen", T.TimestampType()),
    T.StructField("last_seen", T.TimestampType()),
    T.StructField("active", T.BooleanType()),
    T.StructField("supported_indicators", T.ArrayType(T.StringType())),
    T.StructField("asset_type", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("instrument_class", T.StringType()),
    T.StructField("primary_vendor_id", T.StringType()),
    T.StructField("primary_vendor_name", T.StringType()),
    T.StructField("primary_vendor_description", T.StringType()),
])

SOURCES = T.StructType([
    T.StructField("data_source_id", T.StringType()),
    T.StructField("display_name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("attributes", T.ArrayType(T.StringType())),
    T.StructField("vendor_id", T.StringType()),
    T.StructField("vendor_name", T.StringType()),
    T.StructField("vendor_description", T.StringType()),
    T.StructField("supported_indicators", T.ArrayType(T.StringType())),
    T.StructField("first_seen", T.TimestampType()),
    T.StructField("last_seen", T.TimestampType()),
    T.StructField("active", T.BooleanType()),
])

ASSET_METADATA = T.StructType([
    T.StructField("asset_type", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("instrument_class", T.StringType()),
])

SOURCE_METADATA = T.StructType([
    T.StructField("display_name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("attributes", T.ArrayType(T.StringType())),
    T.StructField("vendor_id", T.StringType()),
    T.StructField("vendor_name", T.StringType()),
    T.StructField("vendor_description", T.StringType()),
])

TOTALS = T.StructType([
    T.StructField("asset_id", T.StringType()),
    T.StructField("business_date_year", T.IntegerType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("min_close_price", T.DoubleType()),
    T.StructField("max_close_price", T.DoubleType()),
    T.StructField("average_close_price", T.DoubleType()),
])

REGRESSION_RESULTS = T.StructType([
    T.StructField("asset_id", T.StringType()),
    T.StructField("calculation_time", T.TimestampType()),
    T.StructField("training_points", T.LongType()),
    T.StructField("last_known_close", T.DoubleType()),
    T.StructField("calculated_trend_slope", T.DoubleType()),
    T.StructField("intercept", T.DoubleType()),
    T.StructField("predicted_next_close_price", T.DoubleType()),
    T.StructField("r_squared", T.DoubleType()),
    T.StructField("last_business_date", T.DateType()),
])

# One landed vendor response. Directory: asset_symbol=<symbol>/page_number=<n>/*.json
PAGES = T.StructType([
    T.StructField("dataset", T.StructType([
        T.StructField("column_names", T.ArrayType(T.StringType())),
        T.StructField("data", T.ArrayType(T.ArrayType(T.StringType()))),
    ])),
    T.StructField("datatable", T.StructType([T.StructField("next_cursor_id", T.StringType())])),
    T.StructField("next_cursor_id", T.StringType()),
    T.StructField("asset_symbol", T.StringType()),
    T.StructField("page_number", T.IntegerType()),
])
