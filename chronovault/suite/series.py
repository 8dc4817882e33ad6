"""Gap filling, backfill, summary texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import series, statistics
from ..plans import catalog
from . import views as v
from .joins import MISSING_SQL, NEAREST_SQL, spine_sql
from .registry import oracle, query


@query("tso1_gap_fill", oracle("live", body=f"""
    , {spine_sql('2023-12-30', '2024-02-02')},
    latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY asset_id, business_date
               ORDER BY system_date DESC, ingest_id DESC) AS r FROM live) WHERE r = 1)
    SELECT asset_id, business_date, CAST(NULL AS DOUBLE) AS open_price, CAST(NULL AS DOUBLE) AS high_price,
           CAST(NULL AS DOUBLE) AS low_price, close_price, volume, close_price AS current_price,
           close_price AS adjusted_close_price, close_price AS quoted_price
    FROM spine LEFT JOIN latest USING (asset_id, business_date)"""))
def tso1(spark, sf):
    return series.gap_fill(v.facts(spark, sf), None, "2023-12-30", "2024-02-02")


@query("tso2_backfill", oracle("facts", body=f"""
    , {spine_sql('2023-12-28', '2024-02-03')}, {MISSING_SQL}, {NEAREST_SQL}
    SELECT asset_id, business_date, data_source_id, close_price, close_price AS current_price,
           close_price AS quoted_price, CAST(NULL AS DOUBLE) AS volume,
           CASE WHEN deleted THEN '' ELSE 'adjusted_close_price,close_price,current_price,quoted_price' END AS metric_keys,
           CASE WHEN deleted THEN '' ELSE 'close_price,volume' END AS attributes,
           'BACKFILL' AS source_name, CAST(NULL AS BOOLEAN) AS deleted
    FROM nearest"""))
def tso2(spark, sf):
    rows = series.backfill(v.facts(spark, sf), None, "2023-12-28", "2024-02-03", omit=["volume", "current_price"])
    metrics = F.col("metrics")
    return rows.select(
        "asset_id", "business_date", "data_source_id",
        *(F.try_element_at(metrics, F.lit(m)).alias(m) for m in ("close_price", "current_price", "quoted_price", "volume")),
        F.array_join(F.array_sort(F.map_keys(metrics)), ",").alias("metric_keys"),
        F.array_join("attributes", ",").alias("attributes"),
        F.col("provenance.source_name").alias("source_name"), "deleted",
    )


@query("str6_summary_text", oracle("totals", "trends", "assets", body="""
    , years AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY business_date_year DESC) AS r
                FROM totals) WHERE r = 1)
    SELECT asset_id, concat_ws(chr(10), 'Asset: ' || asset_id,
           'Latest year (' || business_date_year || '): avg ' || round(average_close_price + 1.3e-9, 2) || ', min ' || min_close_price
               || ', max ' || max_close_price,
           'Prediction: next close ' || round(predicted_next_close_price + 1.3e-9, 2) || ' (r² ' || round(r_squared + 1.3e-9, 4) || ')',
           CASE WHEN business_date_year IS NULL AND training_points IS NULL
                THEN 'No yearly summaries or predictions available.' END) AS summary
    FROM assets LEFT JOIN years USING (asset_id) LEFT JOIN trends USING (asset_id)"""))
def str6(spark, sf):
    # exact decimal ties are moved off the rounding edge, as in r6
    facts, shift = v.facts(spark, sf), F.lit(1.3e-9)
    totals = statistics.yearly_totals(facts).withColumn("average_close_price", F.col("average_close_price") + shift)
    trends = statistics.linear_trends(facts).withColumns({
        c: F.col(c) + shift for c in ("predicted_next_close_price", "r_squared")
    })
    return catalog.summary_texts(v.assets(spark, sf), totals, trends)
