"""The query register and the SQL views the oracles share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def r6(c: Column | str) -> Column:
    """Rounding for comparison; the shift moves exact decimal ties off the rounding edge."""
    return F.round((F.col(c) if isinstance(c, str) else c) + F.lit(1.3e-9), 6)


def ntz(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)


def sql_r6(expression: str) -> str:
    return f"round(({expression}) + 1.3e-9, 6)"


VIEWS = {
    "facts": """
        SELECT 'U' || user_id AS asset_id, 'S' || (event_id % 3) * 60 AS data_source_id,
               CAST(ts AS DATE) AS business_date, date_trunc('second', ts) AS system_date,
               CASE WHEN event_type = 'error' THEN TRUE END AS deleted,
               CASE WHEN event_type <> 'error' THEN value END AS close_price,
               CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS volume,
               CAST(event_id AS VARCHAR) AS ingest_id, event_id, event_type
        FROM events""",
    "live": "SELECT * FROM facts WHERE deleted IS DISTINCT FROM TRUE",
    "facts_l": """
        SELECT 'P' || l_partkey AS asset_id, 'S' || l_suppkey AS data_source_id,
               CAST(l_shipdate AS DATE) AS business_date,
               CASE WHEN l_returnflag <> 'R' THEN l_extendedprice / l_quantity END AS close_price,
               CASE WHEN l_returnflag <> 'A' THEN l_extendedprice / l_quantity + 1 END AS close,
               l_quantity AS volume
        FROM lineitem""",
    "sources": """
        SELECT 'S' || s_suppkey AS data_source_id, s_name AS display_name,
               'V' || s_nationkey AS vendor_id, n_name AS vendor_name, 'Region ' || n_regionkey AS vendor_description
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "assets_l": """
        SELECT 'P' || p_partkey AS asset_id, p_brand AS asset_type, p_name AS description, p_type AS instrument_class
        FROM part""",
    "assets": """
        SELECT 'U' || c_custkey AS asset_id, c_mktsegment AS asset_type, c_name AS description,
               'N' || c_nationkey AS instrument_class
        FROM customer""",
    "totals_l": """
        SELECT asset_id, CAST(year(business_date) AS INTEGER) AS business_date_year, COUNT(*) AS record_count,
               min(coalesce(close_price, close)) AS min_close_price, max(coalesce(close_price, close)) AS max_close_price,
               avg(coalesce(close_price, close)) AS average_close_price
        FROM facts_l WHERE coalesce(close_price, close) IS NOT NULL GROUP BY 1, 2""",
    "totals": """
        SELECT asset_id, CAST(year(business_date) AS INTEGER) AS business_date_year, COUNT(*) AS record_count,
               min(close_price) AS min_close_price, max(close_price) AS max_close_price,
               avg(close_price) AS average_close_price
        FROM facts WHERE close_price IS NOT NULL GROUP BY 1, 2""",
    "points": """
        SELECT asset_id, close_price AS y, CAST(row_number() OVER o - 1 AS DOUBLE) AS x
        FROM facts WHERE close_price IS NOT NULL
        WINDOW o AS (PARTITION BY asset_id ORDER BY business_date, system_date, ingest_id)""",
    "fits": """
        SELECT asset_id, COUNT(*) AS training_points, arg_max(y, x) AS last_known_close, regr_slope(y, x) AS slope,
               regr_intercept(y, x) AS icept, regr_r2(y, x) AS r2, avg(x) AS mean_x, avg(y) AS mean_y,
               stddev_pop(y) AS sd_y
        FROM points GROUP BY 1 HAVING COUNT(*) >= 3""",
    "last_dates": "SELECT asset_id, max(business_date) AS last_business_date FROM facts GROUP BY 1",
    "trends": """
        SELECT asset_id, training_points, last_known_close, slope AS calculated_trend_slope, icept AS intercept,
               icept + slope * training_points AS predicted_next_close_price, r2 AS r_squared, last_business_date
        FROM fits JOIN last_dates USING (asset_id)""",
}

_NEEDS = {
    "live": ["facts"], "totals_l": ["facts_l"], "totals": ["facts"], "points": ["facts"],
    "fits": ["points"], "last_dates": ["facts"], "trends": ["fits", "last_dates"],
}


def oracle(*views: str, body: str) -> str:
    """``body`` over the named views and what they need."""
    ordered: list[str] = []

    def add(view: str) -> None:
        for needed in _NEEDS.get(view, []):
            add(needed)
        if view not in ordered:
            ordered.append(view)

    for view in views:
        add(view)
    clauses = ",\n".join(f"{v} AS ({VIEWS[v].strip()})" for v in ordered)
    return f"WITH {clauses}\n{body.strip()}"
