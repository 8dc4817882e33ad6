"""Totals, statistics, trends and comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.metrics import price
from ..functions.numeric import ratio, round_columns
from ..operators import statistics as st
from ..operators.dimensions import union_attributes
from ..plans.catalog import count_rows, list_vendors, series_schema
from . import views as v
from .registry import oracle, query, r6, sql_r6

_TOTALS_SQL = f"""SELECT asset_id, business_date_year, record_count, min_close_price, max_close_price,
       {sql_r6('average_close_price')} AS average_close_price FROM """
_TREND_SQL = f"""SELECT asset_id, training_points, last_known_close,
       {sql_r6('calculated_trend_slope')} AS calculated_trend_slope, {sql_r6('intercept')} AS intercept,
       {sql_r6('predicted_next_close_price')} AS predicted_next_close_price, {sql_r6('r_squared')} AS r_squared,
       last_business_date """


def rounded_totals(totals):
    return totals.withColumn("average_close_price", r6("average_close_price"))


def rounded_trends(trends):
    names = ["calculated_trend_slope", "intercept", "predicted_next_close_price", "r_squared"]
    return trends.drop("calculation_time").withColumns({n: r6(n) for n in names})


@query("agg1_yearly_totals", oracle("totals_l", body=_TOTALS_SQL + "totals_l"))
def agg1(spark, sf):
    return rounded_totals(st.yearly_totals(v.facts_l(spark, sf)))


@query("agg2_distinct", oracle("facts_l", body="SELECT DISTINCT asset_id, data_source_id FROM facts_l"))
def agg2(spark, sf):
    return v.facts_l(spark, sf).select("asset_id", "data_source_id").distinct()


@query("agg3_vendors", oracle("sources", body="""
    SELECT DISTINCT vendor_id, vendor_name, vendor_description FROM sources WHERE vendor_id IS NOT NULL"""))
def agg3(spark, sf):
    return list_vendors(v.sources(spark, sf))


@query("agg4_schema", oracle("facts", "sources", body="""
    , ranked AS (SELECT *, row_number() OVER (PARTITION BY asset_id, data_source_id
                 ORDER BY business_date DESC, system_date DESC, ingest_id DESC) AS r FROM facts)
    SELECT asset_id, data_source_id, CASE WHEN deleted THEN '' ELSE 'close_price,volume' END AS indicator_names,
           business_date AS sample_business_date, vendor_id, vendor_name, vendor_description,
           CASE WHEN vendor_id IS NOT NULL THEN 'business_date,close_price' END AS source_attributes
    FROM ranked LEFT JOIN sources USING (data_source_id) WHERE r = 1"""))
def agg4(spark, sf):
    return series_schema(v.facts(spark, sf), v.sources(spark, sf)).select(
        "asset_id", "data_source_id", F.array_join("indicator_names", ",").alias("indicator_names"),
        "sample_business_date", "vendor_id", "vendor_name", "vendor_description",
        F.array_join("source_attributes", ",").alias("source_attributes"),
    )


@query("agg5_counts", oracle("facts_l", body="SELECT COUNT(*) AS total_count FROM facts_l"))
def agg5(spark, sf):
    return count_rows(v.facts_l(spark, sf))


@query("agg6_distinct_assets", oracle("facts_l", body="""
    SELECT business_date, COUNT(DISTINCT asset_id) AS asset_count FROM facts_l GROUP BY 1"""))
def agg6(spark, sf):
    return v.facts_l(spark, sf).groupBy("business_date").agg(F.countDistinct("asset_id").alias("asset_count"))


# Statistics per asset over the close_price rows of the whole table.
STATS_SQL = """
    series AS (
        SELECT asset_id, business_date, system_date, ingest_id, close_price AS c,
               lag(close_price) OVER o AS p, row_number() OVER o AS step
        FROM facts WHERE close_price IS NOT NULL {where}
        WINDOW o AS (PARTITION BY asset_id ORDER BY business_date, system_date, ingest_id)),
    stats AS (
        SELECT asset_id, COUNT(*) AS count, arg_min(c, step) AS first, arg_max(c, step) AS last, avg(c) AS average,
               (arg_max(c, step) - arg_min(c, step)) / nullif(arg_min(c, step), 0) * 100 AS percent_change,
               CASE WHEN COUNT((c - p) / nullif(p, 0)) = 1 THEN 0.0
                    ELSE stddev_samp((c - p) / nullif(p, 0)) END AS volatility
        FROM series GROUP BY 1)"""
RANGE_SQL = "AND business_date >= DATE '2024-01-03' AND business_date < DATE '2024-01-28'"
_RANGE = {"start": "2024-01-03", "end": "2024-01-28"}


@query("agg7_series_stats", oracle("facts", body=f""",{STATS_SQL.format(where='')}
    SELECT asset_id, count, first, last, {sql_r6('average')} AS average,
           {sql_r6('percent_change')} AS percent_change, {sql_r6('volatility')} AS volatility FROM stats"""))
def agg7(spark, sf):
    stats = st.series_statistics(st.priced_series(v.facts(spark, sf), ["close", "close_price"]))
    return stats.withColumns({n: r6(n) for n in ("average", "percent_change", "volatility")})


# Every asset against its successor: as many pairs as there are assets.
PAIRS_SQL = """
    pairs AS (SELECT DISTINCT asset_id AS asset_a, 'U' || (CAST(substr(asset_id, 2) AS BIGINT) + 1) AS asset_b FROM facts),
    daily AS (SELECT asset_id, business_date, arg_max(c, step) AS c FROM series GROUP BY 1, 2),
    correlations AS (
        SELECT asset_a, asset_b, COUNT(*) AS overlap_days,
               CASE WHEN COUNT(*) >= 2 THEN covar_pop(a.c, b.c) / nullif(stddev_pop(a.c) * stddev_pop(b.c), 0) END AS correlation
        FROM pairs JOIN daily a ON a.asset_id = asset_a JOIN daily b ON b.asset_id = asset_b AND b.business_date = a.business_date
        GROUP BY 1, 2)"""


def successor_pairs(facts):
    following = F.concat(F.lit("U"), (F.substring("asset_id", 2, 20).cast("long") + 1).cast("string"))
    return v.asset_ids(facts).select(F.col("asset_id").alias("asset_a"), following.alias("asset_b"))


@query("agg8_correlation", oracle("facts", body=f""",{STATS_SQL.format(where='')}, {PAIRS_SQL}
    SELECT asset_a, asset_b, {sql_r6('correlation')} AS correlation, overlap_days FROM correlations"""))
def agg8(spark, sf):
    facts = v.facts(spark, sf)
    series = st.priced_series(facts, ["close", "close_price"])
    return st.pair_correlations(series, successor_pairs(facts)).withColumn("correlation", r6("correlation"))


@query("agg9_set_union", oracle("facts", body="""
    SELECT asset_id, 'close_price,volume' AS attributes FROM facts WHERE deleted IS DISTINCT FROM TRUE GROUP BY 1"""))
def agg9(spark, sf):
    united = union_attributes(v.facts(spark, sf), "asset_id")
    return united.select("asset_id", F.array_join("attributes", ",").alias("attributes"))


@query("mlr1_trend_ols", oracle("trends", body=_TREND_SQL + "FROM trends"))
def mlr1(spark, sf):
    return rounded_trends(st.linear_trends(v.facts(spark, sf)))


_RIDGE = "CASE WHEN sd_y = 0 THEN 0.0 ELSE slope / (1 + 0.1 / sd_y) END"


@query("mlr2_trend_ridge", oracle("fits", "last_dates", body=f"""
    , ridge AS (SELECT *, {_RIDGE} AS b, mean_y - ({_RIDGE}) * mean_x AS a FROM fits JOIN last_dates USING (asset_id)),
    residuals AS (
        SELECT asset_id, 1 - sum((y - a - b * x) * (y - a - b * x)) / nullif(sum((y - mean_y) * (y - mean_y)), 0) AS r_squared
        FROM points JOIN ridge USING (asset_id) GROUP BY 1)
    SELECT asset_id, training_points, last_known_close, {sql_r6('b')} AS calculated_trend_slope,
           {sql_r6('a')} AS intercept, {sql_r6('a + b * training_points')} AS predicted_next_close_price,
           {sql_r6('r_squared')} AS r_squared, last_business_date
    FROM ridge JOIN residuals USING (asset_id)"""))
def mlr2(spark, sf):
    return rounded_trends(st.ridge_trends(v.facts(spark, sf)))


_SIDE = ["first", "last", "average", "percent_change", "volatility"]
_COMPARE_SQL = ", ".join(
    f"coalesce({s}.count, 0) AS count_{s}, "
    + ", ".join(f"{s}.{n} AS {n}_{s}" if n in ("first", "last") else f"{sql_r6(f'{s}.{n}')} AS {n}_{s}" for n in _SIDE)
    for s in ("a", "b")
)


def compare_sql() -> str:
    return oracle("facts", body=f""",{STATS_SQL.format(where=RANGE_SQL)}, {PAIRS_SQL}
    SELECT p.asset_a, p.asset_b, {_COMPARE_SQL}, {sql_r6('correlation')} AS correlation,
           coalesce(overlap_days, 0) AS overlap_days
    FROM pairs p LEFT JOIN stats a ON a.asset_id = p.asset_a LEFT JOIN stats b ON b.asset_id = p.asset_b
    LEFT JOIN correlations c ON c.asset_a = p.asset_a AND c.asset_b = p.asset_b""")


def compare(spark, sf):
    facts = v.facts(spark, sf)
    compared = st.compare_pairs(facts, successor_pairs(facts), ["close", "close_price"], **_RANGE)
    flat = []
    for s in ("a", "b"):
        flat.append(F.col(f"stats_{s}.count").alias(f"count_{s}"))
        for n in _SIDE:
            c = F.col(f"stats_{s}.{n}")
            flat.append((c if n in ("first", "last") else r6(c)).alias(f"{n}_{s}"))
    return compared.select("asset_a", "asset_b", *flat, r6("correlation").alias("correlation"), "overlap_days")


query("mlr3_compare_assets", compare_sql())(compare)


@query("mth_ratios", oracle("facts_l", body=f"""
    SELECT asset_id, business_date, {sql_r6('(close - close_price) / nullif(volume - 10, 0)')} AS guarded,
           coalesce(close_price, close) AS totals_price, coalesce(close, close_price) AS trend_price,
           round(volume / 7, 2) AS shown
    FROM facts_l"""))
def mth(spark, sf):
    rows = v.facts_l(spark, sf)
    return round_columns(
        rows.select(
            "asset_id", "business_date",
            r6(ratio(F.col("close") - F.col("close_price"), F.col("volume") - 10)).alias("guarded"),
            price(rows, "close_price", "close").alias("totals_price"),
            price(rows, "close", "close_price").alias("trend_price"),
            (F.col("volume") / 7).alias("shown"),
        ),
        {"shown": 2},
    )
