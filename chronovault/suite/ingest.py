"""Vendor pages, row caps, template rows and ingest status, on pages derived from events."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import fixed, schemas
from ..plans import runs
from ..session import scratch_path
from ..sources import pages as p
from ..sources import tables
from . import views as v
from .registry import query


def _now():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def pages(spark, sf):
    """Each event as one landed page of two data rows; an error event is an empty page.

    A page number is landed several times per asset, so the latest landing counts.
    """
    day = F.col("ts").cast("date")
    row = F.array(day.cast("string"), F.col("value").cast("string"), F.get_json_object("props", "$.k"))
    earlier = F.array(F.date_sub(day, 1).cast("string"), (F.col("value") * 2).cast("string"), F.lit("7"))
    return v.table(spark, sf, "events").select(
        F.concat(F.lit(" u"), F.col("user_id").cast("string")).alias("asset_symbol"),
        (F.col("event_id") % 7 + 1).cast("int").alias("page_number"),
        F.struct(
            F.array(F.lit("Date"), F.lit("Close"), F.lit("Volume")).alias("column_names"),
            F.when(F.col("event_type") != "error", F.array(row, earlier)).alias("data"),
        ).alias("dataset"),
        F.lit(None).cast("struct<next_cursor_id:string>").alias("datatable"),
        F.when(F.col("event_id") % 4 != 0, F.concat(F.lit("c"), F.col("event_id").cast("string")))
        .when(F.col("event_id") % 8 == 0, F.lit("")).alias("next_cursor_id"),
        F.create_map(F.lit("rows"), F.lit("100"), F.lit("API_KEY"), F.lit("secret")).alias("query_parameters"),
        F.col("ts").cast("timestamp").alias("landed_at"), "event_id",
    )


def _walk_sql(max_pages: int = 10**9, max_rows: int = 10**9) -> str:
    return f"""WITH landed AS (
        SELECT * FROM (SELECT *, 'U' || user_id AS asset_id, event_id % 7 + 1 AS page_number,
               CASE WHEN event_type = 'error' THEN 0 ELSE 2 END AS n,
               row_number() OVER (PARTITION BY user_id, event_id % 7 ORDER BY ts DESC, (event_type = 'error'), event_id % 4 = 0) AS c
        FROM events) WHERE c = 1 AND page_number <= {max_pages}),
    walked AS (SELECT * FROM (
        SELECT *, coalesce(sum(n) OVER w, 0) AS first_row, coalesce(bool_or(event_id % 4 = 0) OVER w, FALSE) AS ended,
               page_number - row_number() OVER (PARTITION BY asset_id ORDER BY page_number) = min(page_number) OVER (PARTITION BY asset_id) - 1 AS follows
        FROM landed WINDOW w AS (PARTITION BY asset_id ORDER BY page_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        WHERE NOT ended AND follows AND first_row < {max_rows}),
    data_rows AS (
        SELECT asset_id, page_number, i AS page_row_index, first_row + i AS row_index, event_id,
               CAST(ts AS DATE) - CAST(i AS INTEGER) AS business_date, CASE i WHEN 0 THEN value ELSE value * 2 END AS close_price,
               CASE i WHEN 0 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) ELSE 7.0 END AS volume
        FROM walked CROSS JOIN (VALUES (0), (1)) r(i) WHERE n > 0),
    capped AS (SELECT * FROM data_rows WHERE row_index < {max_rows}),
    usable AS (SELECT asset_id FROM walked GROUP BY 1 HAVING min(n) > 0),
    requested AS (SELECT DISTINCT 'U' || c_custkey AS asset_id FROM customer)"""


_ROW = """asset_id, CAST(page_number AS INTEGER) AS page_number, CAST(page_row_index AS INTEGER) AS page_row_index,
    CAST(row_index AS INTEGER) AS row_index, business_date, close_price, volume"""


def _shown(rows):
    value = [F.col("row")[i] for i in range(3)]
    return rows.select(
        "asset_id", "page_number", "page_row_index", "row_index", value[0].cast("date").alias("business_date"),
        value[1].cast("double").alias("close_price"), value[2].cast("double").alias("volume"),
    )


@query("src1_pages_explode", _walk_sql() + f" SELECT {_ROW} FROM data_rows")
def src1(spark, sf):
    return _shown(p.page_rows(p.reached_pages(p.normalise_pages(pages(spark, sf)))))


@query("src2_row_cap", _walk_sql(fixed.MAX_PAGES, fixed.MAX_ROWS) + f" SELECT {_ROW} FROM capped")
def src2(spark, sf):
    reached = p.reached_pages(p.normalise_pages(pages(spark, sf)), fixed.MAX_PAGES, fixed.MAX_ROWS)
    return _shown(p.cap_rows(p.page_rows(reached), fixed.MAX_ROWS))


def chained_pages(spark, sf):
    """Each event as a landed page that knows the cursor it was asked with and the next one: a customer's events in time.

    Some next cursors have not landed, and some lead back to an earlier page.
    """
    landed = pages(spark, sf).drop("page_number", "next_cursor_id")
    order = Window.partitionBy("asset_symbol").orderBy("landed_at", "event_id")
    named = lambda c: F.concat(F.lit("c"), c.cast("string"))
    following = F.lead("event_id").over(order)
    return landed.withColumns({
        "cursor_id": F.when(F.row_number().over(order) > 1, named(F.col("event_id"))),
        "next_cursor_id": F.when(F.col("event_id") % 53 == 0, F.lit("gone")).when(F.col("event_id") % 31 == 0, named(F.lag("event_id", 2).over(order))).otherwise(named(following)),
    })


@query("src1_cursor_chain", """WITH RECURSIVE ordered AS (
        SELECT 'U' || user_id AS asset_id, event_id, row_number() OVER o AS place, lead(event_id) OVER o AS following, lag(event_id, 2) OVER o AS earlier
        FROM events WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id)),
    links AS (SELECT asset_id, event_id, place, CASE WHEN event_id % 53 = 0 THEN -1 WHEN event_id % 31 = 0 THEN earlier ELSE following END AS next FROM ordered),
    w AS (SELECT asset_id, event_id, next, 1 AS page_number, [event_id] AS visited FROM links WHERE place = 1
          UNION ALL SELECT l.asset_id, l.event_id, l.next, w.page_number + 1, list_append(w.visited, l.event_id)
          FROM w JOIN links l ON l.asset_id = w.asset_id AND l.event_id = w.next AND l.place > 1 WHERE NOT list_contains(w.visited, l.event_id))
    SELECT asset_id, event_id, CAST(page_number AS INTEGER) AS page_number FROM w""")
def src1_chain(spark, sf):
    numbered = p.number_pages(chained_pages(spark, sf).orderBy(F.xxhash64("event_id")))
    return numbered.select(F.upper(F.trim("asset_symbol")).alias("asset_id"), "event_id", "page_number")


_TEMPLATE = """(DATE '2026-06-05', 98500.0, 99200.0, 34500.0), (DATE '2026-06-04', 97200.0, 98450.0, 29800.0),
        (DATE '2026-06-03', 96100.0, 97150.0, 41200.0)"""


def _requested(spark, sf):
    return v.table(spark, sf, "customer").select(v.tagged("u", "c_custkey").alias("asset_id"))


def _batch(spark, sf, **options):
    return p.ingest_batch(pages(spark, sf), _requested(spark, sf), now=_now(), **options)


def _flat(batch):
    entry = {n: F.try_element_at("metrics", F.lit(n)).alias(n) for n in ("open_price", "close_price", "volume", "quoted_price")}
    return batch.select(
        "asset_id", "data_source_id", "business_date", *entry.values(),
        F.array_join("attributes", ",").alias("attributes"),
        F.col("provenance.row_index").alias("row_index"),
        F.array_join(F.map_keys("provenance.query_parameters"), ",").alias("parameters"),
        F.col("source_metadata.display_name").alias("display_name"),
    )


_VENDOR_ROWS = """SELECT asset_id, 'NASDAQ-DATA-LINK.EOD' AS data_source_id, business_date, CAST(NULL AS DOUBLE) AS open_price,
        close_price, volume, close_price AS quoted_price, 'business_date,close_price,volume' AS attributes,
        CAST(row_index AS INTEGER) AS row_index, 'rows' AS parameters, 'Nasdaq Data Link / EOD (' || asset_id || ')' AS display_name
    FROM capped WHERE asset_id IN (SELECT asset_id FROM usable) AND asset_id IN (SELECT asset_id FROM requested)"""
_TEMPLATE_ROWS = f"""SELECT asset_id, 'NASDAQ-DATA-LINK.EOD', d, CAST(o AS DOUBLE), CAST(c AS DOUBLE), CAST(NULL AS DOUBLE), CAST(c AS DOUBLE),
        'business_date,open_price,high_price,low_price,close_price,current_price,adjusted_close_price,quoted_price',
        CAST(row_number() OVER (PARTITION BY asset_id ORDER BY d DESC) - 1 AS INTEGER), '', 'Nasdaq Data Link / EOD Fallback (' || asset_id || ')'
    FROM requested, (VALUES {_TEMPLATE}) t(d, o, c, vol) WHERE asset_id NOT IN (SELECT asset_id FROM usable)"""


@query("src3_fallback_rows", _walk_sql() + _VENDOR_ROWS.replace("close_price, volume, close_price AS", "close_price, CAST(NULL AS DOUBLE) AS volume, close_price AS", 1).replace("business_date,close_price,volume", "business_date,close_price") + " UNION ALL " + _TEMPLATE_ROWS)
def src3(spark, sf):
    return _flat(_batch(spark, sf, omit=["volume"]))


@query("src5_ingest_status", _walk_sql() + """
    SELECT r.asset_id, CASE WHEN COUNT(u.asset_id) > 0 THEN 'ingested' ELSE 'error' END AS status,
           CAST(COUNT(u.asset_id) AS BIGINT) AS "rows"
    FROM requested r LEFT JOIN (SELECT * FROM capped WHERE asset_id IN (SELECT asset_id FROM usable)) u ON u.asset_id = r.asset_id
    GROUP BY 1""")
def src5(spark, sf):
    return p.ingest_status(_requested(spark, sf), _batch(spark, sf, fallback=False))


@query("src6_run_ingest", _walk_sql() + f""",
    stored AS (SELECT asset_id, business_date, close_price, volume FROM capped
               WHERE asset_id IN (SELECT asset_id FROM usable) AND asset_id IN (SELECT asset_id FROM requested)
               UNION ALL SELECT asset_id, d, CAST(c AS DOUBLE), CAST(vol AS DOUBLE) FROM requested, (VALUES {_TEMPLATE}) t(d, o, c, vol)
               WHERE asset_id NOT IN (SELECT asset_id FROM usable))
    SELECT DISTINCT asset_id, business_date, close_price, volume FROM stored""")
def src6(spark, sf):
    """All pages through the public run, twice; what is stored says what the walk reached."""
    root = scratch_path(spark, "warehouse")
    for _ in range(2):
        runs.run_ingest(spark, pages(spark, sf), _requested(spark, sf), root)
    return runs.read_facts(spark, runs.table_paths(root)["facts"]).select("asset_id", "business_date", "close_price", "volume").distinct()


def response_texts(spark, sf):
    """Each event's page as the text of a response. Some are cut off, some are JSON but no page, some are blank."""
    event, body = F.col("event_id"), F.to_json(F.struct("dataset", "next_cursor_id"))
    return pages(spark, sf).withColumn("body", body).select(
        "asset_symbol", "page_number", "landed_at", F.concat(F.lit("landing/"), event.cast("string")).alias("landed_path"),
        F.when(event % 29 == 0, F.expr("substring(body, 1, length(body) - 3)")).when(event % 31 == 0, F.lit('{"dataset": [7]}'))
        .when(event % 37 == 0, F.lit(" ")).otherwise(F.col("body")).alias("body"),
    )


_RESPONSES_SQL = """WITH landed AS (
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY asset_id, page_number ORDER BY ts DESC, n DESC, next DESC NULLS LAST) AS c FROM (
                SELECT 'U' || user_id AS asset_id, CAST(event_id % 7 + 1 AS INTEGER) AS page_number, ts, event_id,
                       CASE WHEN event_id % 29 = 0 THEN 'no JSON' WHEN event_id % 31 = 0 THEN 'no page' WHEN event_id % 37 = 0 THEN 'no JSON' END AS problem,
                       CASE WHEN problem IS NOT NULL OR event_type = 'error' THEN 0 ELSE 2 END AS n,
                       CASE WHEN problem IS NULL AND event_id % 4 <> 0 THEN 'c' || event_id END AS next
                FROM events))
        WHERE c = 1),
    requested AS (SELECT DISTINCT 'U' || c_custkey AS asset_id FROM customer),
    walked AS (SELECT * FROM (
        SELECT *, coalesce(bool_or(next IS NULL) OVER w, FALSE) AS ended,
               page_number - row_number() OVER (PARTITION BY asset_id ORDER BY page_number) = min(page_number) OVER (PARTITION BY asset_id) - 1 AS follows
        FROM landed WINDOW w AS (PARTITION BY asset_id ORDER BY page_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        WHERE NOT ended AND follows),
    walks AS (SELECT asset_id, CASE WHEN min(n) > 0 THEN sum(n) END AS vendor_rows,
                     min('page ' || page_number || ' is ' || problem) AS reason FROM walked GROUP BY 1)"""


@query("src5_failure_reasons", _RESPONSES_SQL + """
    SELECT asset_id, CASE WHEN reason IS NULL THEN 'ingested' ELSE 'error' END AS status,
           CAST(CASE WHEN reason IS NOT NULL THEN 0 ELSE coalesce(vendor_rows, 3) END AS BIGINT) AS "rows", reason
    FROM requested LEFT JOIN walks USING (asset_id)""")
def src5_reasons(spark, sf):
    """Status rows of a run over responses of which some are unreadable: their assets are errors, without template rows."""
    run = p.prepare_ingest(p.parse_pages(response_texts(spark, sf)), _requested(spark, sf), now=_now())
    return p.ingest_status(_requested(spark, sf), run.batch, run.failures)


@query("src1_quarantine", _RESPONSES_SQL + """
    SELECT asset_id, page_number, 'landing/' || event_id AS landed_path, problem FROM landed
    WHERE problem IS NOT NULL AND asset_id IN (SELECT asset_id FROM requested)""")
def src1_quarantine(spark, sf):
    """What stands in the quarantine after the same landing was ingested twice."""
    root = scratch_path(spark, "warehouse")
    run = p.prepare_ingest(p.parse_pages(response_texts(spark, sf)), _requested(spark, sf), now=_now())
    for _ in range(2):
        runs.quarantine(spark, run.unreadable, root)
    held = tables.read_table(spark, runs.table_paths(root)["quarantine"], schemas.QUARANTINE)
    return held.select("asset_id", "page_number", "landed_path", "problem")


@query("src6_ingest_log", _RESPONSES_SQL + """
    SELECT (SELECT COUNT(*) FROM landed) AS pages, (SELECT COUNT(problem) FROM landed) AS unreadable_pages,
           (SELECT CAST(sum(n) AS BIGINT) FROM landed) AS landed_rows,
           CAST(sum(CASE WHEN reason IS NULL THEN coalesce(vendor_rows, 3) ELSE 0 END) AS BIGINT) AS "rows",
           3 * COUNT(*) FILTER (WHERE reason IS NULL AND vendor_rows IS NULL) AS template_rows, CAST(0 AS BIGINT) AS undated_rows
    FROM requested LEFT JOIN walks USING (asset_id)""")
def src6_log(spark, sf):
    """The counts that a whole run took while it wrote."""
    root = scratch_path(spark, "warehouse")
    runs.run_ingest(spark, p.parse_pages(response_texts(spark, sf)), _requested(spark, sf), root)
    return tables.read_table(spark, runs.table_paths(root)["ingest_log"], schemas.INGEST_LOG).drop("run_at")
