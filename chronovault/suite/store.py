"""Tables kept below a warehouse folder: moments and sketches by month, filtered appends, migration."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..operators import moments, sketches, statistics, versions
from ..plans import derived, migration, runs
from ..session import scratch_path
from ..sources import bucketed, tables
from . import views as v
from .aggregates import STATS_SQL, rounded_totals, rounded_trends
from .expressions import LEGACY_SQL, legacy_dates
from .registry import VIEWS, ntz, oracle, query, r6, sql_r6

BUCKETS = 8


def order_facts(spark, sf):
    """Orders as prices of their customers: years of dates, a unique id, and the status."""
    orders, at = v.table(spark, sf, "orders"), F.col("o_orderdate").cast("timestamp")
    none = {f.name: F.lit(None).cast(f.dataType) for f in schemas.FACTS.fields}
    return orders.select(*[c.alias(n) for n, c in (none | {
        "asset_id": v.tagged("C", "o_custkey"), "data_source_id": F.lit("S"), "business_date": at.cast("date"), "system_date": at,
        "metrics": F.create_map(F.lit("close_price"), F.col("o_totalprice")), "ingest_id": F.col("o_orderkey").cast("string"),
    }).items()], F.col("o_orderstatus").alias("status"))


def _order_sql(*views: str, body: str) -> str:
    """``body`` over orders in the place of facts, and the named views on them."""
    facts = """SELECT 'C' || o_custkey AS asset_id, CAST(o_orderdate AS DATE) AS business_date, o_orderdate AS system_date,
               o_totalprice AS close_price, CAST(o_orderkey AS VARCHAR) AS ingest_id, o_orderstatus AS status FROM orders"""
    return "WITH " + ",\n".join([f"facts AS ({facts})", *(f"{name} AS ({VIEWS[name].strip()})" for name in views)]) + body


def _stored_in_three(spark, sf, names):
    """A warehouse that got the orders in three batches, whose dates and rows overlap."""
    root, orders = scratch_path(spark, "warehouse"), order_facts(spark, sf)
    settled, late = F.col("status") == "F", F.col("business_date") >= F.lit("1999-01-01").cast("date")
    for part in (settled & ~late, late, ~settled | F.col("status").isNull()):
        derived.append_and_refresh(spark, orders.where(part), root, names=names)
    return root


@query("mlr1_stored_moments", _order_sql("points", "fits", "last_dates", "trends", body=f""", {STATS_SQL.format(where='')}
    SELECT asset_id, count, first, last, {sql_r6('average')} AS average, {sql_r6('percent_change')} AS percent_change,
           {sql_r6('volatility')} AS volatility, training_points, last_known_close, {sql_r6('calculated_trend_slope')} AS calculated_trend_slope,
           {sql_r6('intercept')} AS intercept, {sql_r6('predicted_next_close_price')} AS predicted_next_close_price,
           {sql_r6('r_squared')} AS r_squared, last_business_date
    FROM stats LEFT JOIN trends USING (asset_id)"""))
def mlr1_stored(spark, sf):
    """Statistics and trends from stored months, after three appends."""
    months = derived.read_derived(spark, _stored_in_three(spark, sf, ["moments"]), "moments")
    stats = moments.statistics_of_months(months).withColumns({n: r6(n) for n in ("average", "percent_change", "volatility")})
    return stats.join(rounded_trends(moments.trends_of_months(months)), "asset_id", "left")


@query("agg1_stored_totals", _order_sql("totals", body=f"""
    SELECT asset_id, business_date_year, record_count, min_close_price, max_close_price, {sql_r6('average_close_price')} AS average_close_price
    FROM totals"""))
def agg1_stored(spark, sf):
    """Yearly totals from stored months, after three appends."""
    months = derived.read_derived(spark, _stored_in_three(spark, sf, ["moments"]), "moments")
    return rounded_totals(moments.totals_of_months(months))


@query("agg6_sketched_windows", _order_sql(body="""
    , ends AS (SELECT DISTINCT business_date AS end_date FROM facts)
    SELECT end_date, COUNT(*) AS record_count, COUNT(DISTINCT asset_id) AS asset_count, TRUE AS within_error
    FROM ends JOIN facts ON business_date BETWEEN end_date - 29 AND end_date GROUP BY 1"""))
def agg6_sketched(spark, sf):
    """Every window of 30 days: exact distinct assets, and whether the estimate of the stored sketches is within four standard errors."""
    root = _stored_in_three(spark, sf, ["asset_sketches"])
    estimated = sketches.sketched_windows(derived.read_sketches(spark, root))
    both = estimated.join(sketches.counted_windows(order_facts(spark, sf)), "end_date")
    error = F.abs(F.col("asset_estimate") - F.col("asset_count"))
    within = error <= F.greatest(F.lit(1.0), F.col("asset_count") * (4 * sketches.relative_error()))
    return both.select("end_date", "record_count", "asset_count", within.alias("within_error"))


@query("snk1_filtered_append", _order_sql(body="""
    SELECT date_trunc('month', business_date)::DATE AS business_month, COUNT(*) AS n_rows, COUNT(DISTINCT ingest_id) AS n_ids FROM facts GROUP BY 1"""))
def snk1_filtered(spark, sf):
    """Two overlapping batches: stored ids that the second cannot have are left out before the ids are shuffled."""
    path, orders = scratch_path(spark, "facts"), order_facts(spark, sf)
    tables.append_facts(spark, orders.where("status <> 'P'"), path)
    tables.append_facts(spark, orders.where("status <> 'O' OR status IS NULL"), path)
    stored = tables.read_table(spark, path, schemas.STORED_FACTS)
    return stored.groupBy("business_month").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("ingest_id").alias("n_ids"))


@query("snk9_migrate_store", oracle("facts", body=f"""
    , legacy AS (SELECT event_id, system_date AS migrated_date FROM ({LEGACY_SQL}))
    SELECT ingest_id, CASE WHEN migrated_date IS NULL THEN 'unparseable' ELSE 'migrated' END AS status, migrated_date AS system_date
    FROM facts JOIN legacy USING (event_id)"""))
def snk9_store(spark, sf):
    """A stored table with text dates: counted by a dry run, migrated, migrated again; every row stands in one of two tables."""
    root = scratch_path(spark, "warehouse")
    facts = v.facts(spark, sf).withColumn("provenance", F.lit(None).cast(schemas.PROVENANCE))
    texts = legacy_dates(spark, sf).withColumnRenamed("system_date", "system_date_text")
    legacy = facts.join(texts, "event_id").withColumns({"system_date": F.col("system_date_text"), "business_month": F.trunc("business_date", "month")})
    legacy.select(*schemas.LEGACY_FACTS.names).write.partitionBy("business_month").parquet(f"{root}/legacy")
    migration.migrate_store(spark, f"{root}/legacy", root)
    for _ in range(2):
        migration.migrate_store(spark, f"{root}/legacy", root, dry_run=False)
    moved = tables.read_table(spark, runs.table_paths(root)["facts"], schemas.STORED_FACTS).select("ingest_id", F.lit("migrated").alias("status"), ntz("system_date"))
    unread = migration.read_unparseable(spark, root).select("ingest_id", F.lit("unparseable").alias("status"), F.lit(None).cast("timestamp_ntz").alias("system_date"))
    return moved.unionByName(unread)


def _bucketed_orders(spark, sf):
    """A bucketed store that got the orders in two batches which overlap."""
    path, orders = scratch_path(spark, "bucketed"), order_facts(spark, sf)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    settled = F.col("status") == "F"
    for part in (orders.where(settled), orders):
        bucketed.append_bucketed(spark, part, name, path, BUCKETS)
    return bucketed.open_bucketed(spark, name, path, BUCKETS)


@query("win1_bucketed_versions", _order_sql(body="""
    SELECT asset_id, business_date, close_price, ingest_id FROM (
        SELECT *, row_number() OVER (PARTITION BY asset_id, business_date ORDER BY system_date DESC, ingest_id DESC) AS r FROM facts) WHERE r = 1"""))
def win1_bucketed(spark, sf):
    """Latest versions, read from their buckets."""
    latest = versions.latest_versions(_bucketed_orders(spark, sf))
    return latest.select("asset_id", "business_date", "close_price", "ingest_id")


@query("mlr1_bucketed_trends", _order_sql("points", "fits", "last_dates", "trends", body=f"""
    SELECT asset_id, training_points, last_known_close, {sql_r6('calculated_trend_slope')} AS calculated_trend_slope,
           {sql_r6('intercept')} AS intercept, {sql_r6('predicted_next_close_price')} AS predicted_next_close_price,
           {sql_r6('r_squared')} AS r_squared, last_business_date
    FROM trends"""))
def mlr1_bucketed(spark, sf):
    """Trends whose cells are made in the buckets."""
    return rounded_trends(statistics.linear_trends(_bucketed_orders(spark, sf)))
