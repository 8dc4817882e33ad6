"""Version picks, lineage, ordering and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed import COMMON_INDICATORS
from ..operators import filters, ordering, statistics, versions

from . import views as v
from .registry import ntz, oracle, query, r6, sql_r6

_COLUMNS = "asset_id, data_source_id, business_date, system_date, close_price, volume, ingest_id"
_NEWEST = "system_date DESC, ingest_id DESC"
_ASOF = "system_date <= TIMESTAMP '2024-01-20 12:00:00'"


def shown(rows):
    return rows.select(
        "asset_id", "data_source_id", "business_date", ntz("system_date"), "close_price", "volume", "ingest_id"
    )


def latest_sql(view: str, keys: str, where: str = "TRUE", order: str = _NEWEST, k: int = 1, after: str = "TRUE") -> str:
    return oracle(view, body=f"""
    SELECT {_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS r
                            FROM {view} WHERE {where}) WHERE r <= {k} AND {after}""")


@query("win1_latest_versions", latest_sql("live", "asset_id, data_source_id, business_date"))
def win1(spark, sf):
    return shown(versions.latest_versions(v.facts(spark, sf)))


@query("win2_latest_by_asset", latest_sql("live", "asset_id, business_date"))
def win2(spark, sf):
    return shown(versions.latest_by_asset(v.facts(spark, sf)))


@query("win2_asof", latest_sql(
    "live", "asset_id, business_date",
    f"{_ASOF} AND business_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'",
))
def win2_asof(spark, sf):
    return shown(versions.latest_by_asset(
        v.facts(spark, sf), start="2024-01-05", end="2024-01-25", as_of_instant="2024-01-20T14:00:00.500+02:00"
    ))


@query("win2_tombstones_apply", latest_sql("facts", "asset_id, business_date", after="deleted IS DISTINCT FROM TRUE"))
def win2_apply(spark, sf):
    return shown(versions.latest_by_asset(v.facts(spark, sf), tombstones="apply"))


@query("win2_asof_join", oracle("live", "facts", body=f"""
    , requests AS (SELECT event_id AS request_id, asset_id, business_date, system_date + to_hours(CAST(event_id % 49 - 24 AS INTEGER)) AS instant FROM facts),
    daily AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY asset_id, business_date, system_date ORDER BY ingest_id DESC) AS r FROM live) WHERE r = 1)
    SELECT request_id, q.asset_id, q.business_date, instant, d.ingest_id, d.data_source_id, d.close_price, d.system_date
    FROM requests q ASOF LEFT JOIN daily d ON q.asset_id = d.asset_id AND q.business_date = d.business_date AND q.instant >= d.system_date"""))
def win2_asof_join(spark, sf):
    """For each event, its asset's price of that day as it was known up to a day before or after."""
    facts = v.facts(spark, sf)
    instant = F.timestamp_add("HOUR", (F.col("event_id") % 49 - 24).cast("int"), F.col("system_date"))
    requests = facts.select(F.col("event_id").alias("request_id"), "asset_id", "business_date", instant.alias("instant"))
    known = facts.select("asset_id", "business_date", "system_date", "ingest_id", "deleted", "data_source_id", "close_price")
    found = versions.asof_join(requests, known).drop("deleted")
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("instant", "system_date")})


def indicators_sql(limit: str = "") -> str:
    return oracle("live", "sources", body=f"""
    SELECT asset_id, data_source_id, business_date, system_date, close_price, volume,
           vendor_id, vendor_name, vendor_description
    FROM (SELECT *, row_number() OVER (PARTITION BY asset_id, data_source_id, business_date ORDER BY {_NEWEST}) AS r FROM live)
    LEFT JOIN sources USING (data_source_id) WHERE r = 1
    ORDER BY asset_id, data_source_id, business_date DESC {limit}""")


def shown_indicators(rows):
    unused = [m for m in COMMON_INDICATORS if m not in ("close_price", "volume")]
    return rows.drop(*unused).withColumn("system_date", F.col("system_date").cast("timestamp_ntz"))


@query("win3_common_indicators", indicators_sql())
def win3(spark, sf):
    return shown_indicators(versions.common_indicators(v.facts(spark, sf), v.sources(spark, sf), limit=None))


WIN4_SQL = latest_sql(
    "facts", "asset_id, data_source_id, business_date",
    "business_date >= DATE '2024-01-05' AND business_date < DATE '2024-01-25'",
)


def tool_series(spark, sf):
    return shown(versions.tool_series(v.facts(spark, sf), start="2024-01-05", end="2024-01-25"))


query("win4_tool_series", WIN4_SQL)(tool_series)


@query("win4_tool_series_newest", oracle("facts", body=f"""
    SELECT {_COLUMNS} FROM (
        SELECT *, row_number() OVER (PARTITION BY asset_id, data_source_id ORDER BY business_date DESC) AS place FROM (
            SELECT *, row_number() OVER (PARTITION BY asset_id, data_source_id, business_date ORDER BY {_NEWEST}) AS r FROM facts)
        WHERE r = 1) WHERE place <= 2"""))
def win4_newest(spark, sf):
    return shown(versions.tool_series(v.facts(spark, sf), limit=2))


@query("win6_one_history", oracle("facts", body=f"SELECT {_COLUMNS} FROM facts WHERE asset_id = 'U7' AND data_source_id = 'S60'"))
def win6_one(spark, sf):
    return shown(versions.find_all(v.facts(spark, sf), "U7", "S60"))


@query("win5_find_latest", latest_sql("facts", "asset_id, data_source_id"))
def win5(spark, sf):
    return shown(versions.find_latest(v.facts(spark, sf)))


@query("win6_history", oracle("facts", body=f"SELECT {_COLUMNS} FROM facts"))
def win6(spark, sf):
    return shown(versions.find_all(v.facts(spark, sf)))


@query("win7_latest_year", oracle("totals_l", body="""
    SELECT asset_id, max(business_date_year) AS business_date_year, arg_max(record_count, business_date_year) AS record_count
    FROM totals_l GROUP BY 1"""))
def win7(spark, sf):
    totals = statistics.yearly_totals(v.facts_l(spark, sf))
    return versions.latest_year(totals).select("asset_id", "business_date_year", "record_count")


_ORDERED = "OVER (PARTITION BY asset_id ORDER BY business_date, system_date, ingest_id)"


@query("win8_timestep", oracle("facts", body=f"""
    SELECT asset_id, ingest_id, row_number() {_ORDERED} - 1 AS time_step FROM facts"""))
def win8(spark, sf):
    return ordering.time_steps(v.facts(spark, sf), "ingest_id").select("asset_id", "ingest_id", "time_step")


@query("win9_returns", oracle("facts", body=f"""
    , lagged AS (SELECT *, lag(close_price) {_ORDERED} AS previous FROM facts WHERE close_price IS NOT NULL)
    SELECT asset_id, ingest_id, previous, {sql_r6('(close_price - previous) / nullif(previous, 0)')} AS "return" FROM lagged"""))
def win9(spark, sf):
    series = statistics.priced_series(v.facts(spark, sf), ["close", "close_price"])
    return statistics.series_returns(series).select("asset_id", "ingest_id", "previous", r6("return").alias("return"))


@query("tso5_series_swapped_bounds", oracle("facts", "assets", body=f"""
    SELECT {_COLUMNS} FROM facts WHERE asset_id IN (SELECT asset_id FROM assets)
    AND business_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'"""))
def tso5(spark, sf):
    return shown(versions.series_between(v.facts(spark, sf), v.assets(spark, sf), "2024-01-21", "2024-01-08"))


_LATEST_DAY = f"business_date DESC, {_NEWEST}"


@query("tso6_asset_lineage", oracle("facts", body=f"SELECT {_COLUMNS} FROM facts"))
def tso6(spark, sf):
    return shown(versions.asset_lineage(v.facts(spark, sf)))


@query("tso6_asset_lineage_newest", latest_sql("facts", "asset_id", order=_LATEST_DAY, k=3))
def tso6_newest(spark, sf):
    return shown(versions.asset_lineage(v.facts(spark, sf), limit=3))


@query("tso6_one_asset", latest_sql("facts", "asset_id", "asset_id = 'U7'", order=_LATEST_DAY, k=5))
def tso6_one(spark, sf):
    return shown(versions.asset_lineage(v.facts(spark, sf), "U7", limit=5))


@query("tso7_source_lineage", oracle("facts", body=f"SELECT {_COLUMNS} FROM facts"))
def tso7(spark, sf):
    return shown(versions.source_lineage(v.facts(spark, sf)))


@query("tso7_source_lineage_newest", latest_sql("facts", "data_source_id", order=_LATEST_DAY, k=200))
def tso7_newest(spark, sf):
    return shown(versions.source_lineage(v.facts(spark, sf), limit=200))


@query("srt2_topk", oracle("facts", body=f"""
    SELECT {_COLUMNS} FROM facts ORDER BY {_LATEST_DAY}, asset_id LIMIT 100"""))
def srt2(spark, sf):
    return shown(filters.page(v.facts(spark, sf), *versions.latest_day(), F.asc("asset_id"), limit=100))


@query("srt3_page", oracle("assets_l", body="""
    SELECT asset_id, asset_type, description, instrument_class FROM assets_l ORDER BY asset_id LIMIT 25 OFFSET 50"""))
def srt3(spark, sf):
    return filters.page(v.assets_l(spark, sf), F.asc("asset_id"), limit=25, offset=50)
