import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from chronovault import schemas
from chronovault.plans import runs
from chronovault.sources import pages as p
from chronovault.sources import tables
from tests.helpers import day, metric, rows

HEADER = ["Date", "Open", "Close", "Volume"]


def land(root, symbol, number, data, cursor=None, header=HEADER):
    folder = root / f"asset_symbol={symbol.replace('=', '%3D')}" / f"page_number={number}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "page.json").write_text(json.dumps({
        "dataset": {"column_names": header, "data": data}, "next_cursor_id": cursor,
    }, indent=1))


def price_rows(first, n):
    return [[f"2026-05-{first + i:02d}", 10.0 + i, 20.0 + i, 100 + i] for i in range(n)]


@pytest.fixture
def landed(spark, tmp_path):
    root = tmp_path / "landing"
    land(root, "BTCUSD", 1, price_rows(1, 3), "c1")
    land(root, "BTCUSD", 2, price_rows(4, 4), "c2")
    land(root, "BTCUSD", 3, price_rows(8, 4))
    land(root, "CL=F", 1, price_rows(1, 2))
    land(root, "CL=F", 2, price_rows(3, 2))  # not reached: page 1 has no cursor
    land(root, "AAPL", 1, price_rows(1, 2), "c1")
    land(root, "AAPL", 2, [])  # an empty page on the walk
    land(root, "MSFT", 1, [["2026-05-01", None, 7, "n/a"]])
    return p.read_pages(spark, str(root))


def requested(spark):
    return runs.asset_frame(spark, [" btcusd", "CL=F", "AAPL", "MSFT", "NEWCO", "  "])


def test_walk_and_row_cap(spark, landed):
    reached = p.reached_pages(p.normalise_pages(landed), max_rows=5)
    assert rows(reached, "asset_id", "page_number") == [
        ("AAPL", 1), ("AAPL", 2), ("BTCUSD", 1), ("BTCUSD", 2), ("CL=F", 1), ("MSFT", 1),
    ]
    capped = p.cap_rows(p.page_rows(reached), 5).where("asset_id = 'BTCUSD'")
    assert rows(capped, "page_number", "page_row_index", "row_index") == [(1, 0, 0), (1, 1, 1), (1, 2, 2), (2, 0, 3), (2, 1, 4)]
    everything = p.page_rows(p.reached_pages(p.normalise_pages(landed))).where("asset_id = 'BTCUSD'")
    assert everything.count() == 11


def test_batch(spark, landed):
    batch = p.ingest_batch(landed, requested(spark), max_pages=5, max_rows=5)
    counts = dict(rows(batch.groupBy("asset_id").count()))
    assert counts == {"BTCUSD": 5, "CL=F": 2, "MSFT": 1, "AAPL": 3, "NEWCO": 3}
    first = batch.where("asset_id = 'BTCUSD' and provenance.row_index = 0").collect()[0]
    assert first.data_source_id == "NASDAQ-DATA-LINK.QDL/BITFINEX" and str(first.business_date) == "2026-05-01"
    assert first.metrics == {
        "open_price": 10.0, "close_price": 20.0, "volume": 100.0, "current_price": 20.0,
        "adjusted_close_price": 20.0, "quoted_price": 20.0,
    }
    assert first.attributes == ["business_date", "open_price", "close_price", "volume"]
    assert first.provenance.source_url.endswith("/BITFINEX/BTCUSD.json") and first.provenance.next_cursor_id == "c1"
    assert first.provenance.columns == ["date", "open", "close", "volume"]
    assert first.source_metadata.display_name == "Nasdaq Data Link / Bitfinex (BTCUSD)"
    odd = batch.where("asset_id = 'MSFT'").select(metric("open_price"), metric("close_price"), metric("volume")).collect()[0]
    assert tuple(odd) == (None, 7.0, None)


def test_template_rows(spark, landed):
    batch = p.ingest_batch(landed, requested(spark)).where("asset_id = 'NEWCO'")
    assert [(str(r[0]), r[1], r[2]) for r in rows(batch, "business_date", metric("close_price"), "provenance.row_index")] == [
        ("2026-06-03", 97150.0, 2), ("2026-06-04", 98450.0, 1), ("2026-06-05", 99200.0, 0),
    ]
    sample = batch.limit(1).collect()[0]
    assert sample.provenance.source_name == "Nasdaq Data Link / EOD Fallback"
    assert sample.asset_metadata.description == "NEWCO financial instrument."


def test_omit_applies_to_metrics_and_attributes(spark, landed):
    batch = p.ingest_batch(landed, requested(spark), omit=["volume", "current_price"])
    keys = batch.select(F.explode(F.map_keys("metrics")).alias("k")).distinct()
    listed = batch.select(F.explode("attributes").alias("k")).distinct()
    for found in (keys, listed):
        assert not {"volume", "current_price"} & {r[0] for r in rows(found)}


def test_status(spark, landed):
    asked = runs.asset_frame(spark, [" btcusd ", "AAPL", "NEWCO", " "])
    status = p.ingest_status(asked, p.ingest_batch(landed, asked, fallback=False, max_rows=5))
    assert rows(status) == [("AAPL", "error", 0), ("BTCUSD", "ingested", 5), ("NEWCO", "error", 0)]


def test_a_page_landed_twice_counts_in_its_latest_form(spark):
    schema = "asset_symbol string, page_number int, dataset struct<column_names:array<string>,data:array<array<string>>>, datatable struct<next_cursor_id:string>, next_cursor_id string, landed_at timestamp_ntz"

    def page(hour, close):
        return ("a", 1, (["Date", "Close"], [["2026-05-01", close]]), None, None, datetime(2026, 5, 1, hour))

    pages = spark.createDataFrame([page(1, "1"), page(3, "3"), page(2, "2")], schema)
    batch = p.ingest_batch(pages)
    assert rows(batch, "asset_id", metric("close_price")) == [("A", 3.0)]


def test_a_page_without_header_has_no_metrics(spark, tmp_path):
    land(tmp_path / "landing", "A", 1, [["2026-05-01", 1.0]], header=None)
    batch = p.ingest_batch(p.read_pages(spark, str(tmp_path / "landing")))
    assert rows(batch.select("metrics", "attributes")) == [({}, ["business_date"])]


def test_run_ingest_twice_stores_once_and_feeds_analytics(spark, landed, tmp_path):
    root = str(tmp_path / "warehouse")
    asked = runs.asset_frame(spark, ["BTCUSD", "NEWCO"])
    for _ in range(2):
        status = runs.run_ingest(spark, landed, asked, root, max_rows=5)
        assert rows(status) == [("BTCUSD", "ingested", 5), ("NEWCO", "ingested", 3)]
    paths = runs.table_paths(root)
    facts = runs.read_facts(spark, paths["facts"])
    assert facts.count() == 8
    assets = runs.read_assets(spark, root)
    assert rows(assets, "asset_id", "active", "asset_type", "primary_vendor_id") == [
        ("BTCUSD", True, "cryptocurrency", "NASDAQ"), ("NEWCO", True, "equity", "NASDAQ"),
    ]
    assert rows(runs.read_sources(spark, root), "data_source_id", "display_name") == [
        ("NASDAQ-DATA-LINK.EOD", "Nasdaq Data Link / EOD Fallback (NEWCO)"),
        ("NASDAQ-DATA-LINK.QDL/BITFINEX", "Nasdaq Data Link / Bitfinex (BTCUSD)"),
    ]
    totals, trends = runs.run_analytics(spark, root)
    summary = runs.run_summary(totals, trends, ["BTCUSD", "UNKNOWN"])
    assert rows(summary) == [("BTCUSD", 2026, 5, pytest.approx(21.1))]  # closes 20 21 22 20 21: 20.6 + 0.1 * 5
    assert runs.recent_records(facts, ["NEWCO"]).count() == 3


def test_backfill_delete_and_analytics_on_the_store(spark, landed, tmp_path):
    root = str(tmp_path / "warehouse")
    empty_totals, empty_trends = runs.run_analytics(spark, root)
    assert empty_totals.count() == empty_trends.count() == 0
    asked = runs.asset_frame(spark, ["BTCUSD"])
    runs.run_ingest(spark, landed, asked, root, max_rows=5)
    for expected in (("BTCUSD", "ok", 2), ("BTCUSD", "noop", 0)):
        assert rows(runs.run_backfill(spark, root, asked, "2026-05-04", "2026-05-07")) == [expected]
    facts = runs.read_facts(spark, runs.table_paths(root)["facts"])
    assert rows(facts.where("provenance.source_name = 'BACKFILL'"), "business_date", metric("close_price")) == [
        (day("2026-05-06"), 21.0), (day("2026-05-07"), 21.0),
    ]
    requests = runs.asset_frame(spark, ["btcusd", "ghost"])
    for _ in range(2):
        runs.mark_assets_deleted(spark, root, requests, datetime(2030, 1, 1, tzinfo=timezone.utc))
    facts = runs.read_facts(spark, runs.table_paths(root)["facts"])
    assert rows(facts.where("deleted"), "asset_id", "business_date") == [("BTCUSD", day("2030-01-01")), ("GHOST", day("2030-01-01"))]
    assert rows(runs.read_assets(spark, root), "asset_id", "active", "last_seen") == [("BTCUSD", False, datetime(2030, 1, 1))]
    assert runs.read_assets(spark, root).collect()[0].supported_indicators == [
        "business_date", "close_price", "open_price", "volume",
    ]
    before = rows(runs.read_assets(spark, root)), rows(runs.read_sources(spark, root))
    runs.compact_dimensions(spark, root)
    assert (rows(runs.read_assets(spark, root)), rows(runs.read_sources(spark, root))) == before
    assert tables.read_table(spark, runs.table_paths(root)["asset_changes"], schemas.ASSETS).count() == 1
    totals, trends = runs.run_analytics(spark, root, predictive=False)
    assert rows(totals, "asset_id", "record_count") == [("BTCUSD", 7)] and trends.count() == 0


def test_without_a_request_all_supported_assets_are_ingested(spark, landed, tmp_path):
    status = runs.run_ingest(spark, landed, None, str(tmp_path / "warehouse"), max_rows=5)
    assert rows(status.groupBy("status").agg(F.count("*"), F.sum("rows"))) == [("ingested", 20, 5 + 2 + 1 + 17 * 3)]


def test_all_landed_rows_count_without_a_cap(spark, landed):
    batch = p.ingest_batch(landed, requested(spark), max_pages=None)
    assert dict(rows(batch.groupBy("asset_id").count())) == {"BTCUSD": 11, "CL=F": 2, "MSFT": 1, "AAPL": 3, "NEWCO": 3}
    assert batch.where("asset_id = 'BTCUSD' AND source_metadata.display_name LIKE '%Fallback%'").isEmpty()
    for bad in (0, -1, True, 2.5):
        with pytest.raises(ValueError):
            p.ingest_batch(landed, requested(spark), max_pages=bad)


def test_the_walk_stops_at_an_empty_cursor_and_at_a_hole(spark, tmp_path):
    for symbol, number, cursor in (("A", 1, "c"), ("A", 3, "c"), ("B", 1, ""), ("B", 2, "c"), ("C", 1, "c"), ("C", 2, "c"), ("C", 4, "c")):
        land(tmp_path / "landing", symbol, number, price_rows(number, 1), cursor)
    reached = p.reached_pages(p.normalise_pages(p.read_pages(spark, str(tmp_path / "landing"))))
    assert rows(reached, "asset_id", "page_number") == [("A", 1), ("B", 1), ("C", 1), ("C", 2)]


def test_an_unchanged_row_at_another_place_is_no_version(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    asked = runs.asset_frame(spark, ["A"])
    for n, data in enumerate((price_rows(1, 2), price_rows(1, 2)[::-1] + price_rows(3, 1))):
        land(tmp_path / f"landing{n}", "A", 1, data)
        runs.run_ingest(spark, p.read_pages(spark, str(tmp_path / f"landing{n}")), asked, root)
    assert runs.read_facts(spark, runs.table_paths(root)["facts"]).count() == 3


def chain_frame(spark, pages):
    """Pages of (asset, cursor asked for, next cursor, landing hour, body)."""
    schema = "asset_symbol string, cursor_id string, datatable struct<next_cursor_id:string>, next_cursor_id string, landed_at timestamp, body string"
    return spark.createDataFrame([(a, c, None, n, datetime(2026, 5, 1, h), b) for a, c, n, h, b in pages], schema)


def test_pages_are_numbered_by_their_cursors(spark):
    long = [("long", f"c{i}" if i else None, f"c{i + 1}", 1, f"l{i}") for i in range(37)]
    pages = long[::-1] + [
        ("hole", "", "a", 1, "h0"), ("hole", "a", "b", 1, "h1"), ("hole", "c", "", 1, "not reached"),
        ("circle", None, "a", 1, "o0"), ("circle", "a", "b", 1, "o1"), ("circle", "b", "a", 1, "o2"),
        ("alone", "x", "y", 1, "no first page"), ("alone", "y", "x", 1, "no first page"),
        ("heads", None, "a", 1, "old"), ("heads", None, "b", 2, "new"), ("heads", "a", None, 1, "of the old"), ("heads", "b", None, 1, "of the new"),
        ("self", None, "s", 1, "s0"), ("self", "s", "s", 1, "s1"), ("  ", None, None, 1, "no asset"), (None, None, None, 1, "no asset"),
    ]
    found = p.number_pages(chain_frame(spark, pages))
    expected = [(f"l{i}", i + 1) for i in range(37)] + [
        ("h0", 1), ("h1", 2), ("o0", 1), ("o1", 2), ("o2", 3), ("new", 1), ("old", 1), ("of the new", 2), ("s0", 1), ("s1", 2)]
    assert sorted((r["body"], r["page_number"]) for r in found.collect()) == sorted(expected)
    assert p.number_pages(chain_frame(spark, [])).collect() == []


def test_no_window_or_walk_carries_the_rows_of_pages(spark, landed):
    plan = p.walk(p.normalise_pages(landed))._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "page_number" in line and "sum(" in line]
    assert windows and all("layout" not in line and "rows#" not in line.replace("n_rows#", "") for line in windows)
    assert rows(p.walk(p.normalise_pages(landed)).where("asset_id = 'BTCUSD'"), "page_number", "n_rows", "first_row") == [(1, 3, 0), (2, 4, 3), (3, 4, 7)]


def broken_landing(root):
    land(root, "CUT", 1, price_rows(1, 2), "c1")
    land(root, "CUT", 2, price_rows(3, 2))
    cut = root / "asset_symbol=CUT" / "page_number=2" / "page.json"
    cut.write_text(cut.read_text()[:-9])
    land(root, "SHAPE", 1, {"2026-05-01": 3.0})
    land(root, "FINE", 1, price_rows(1, 2))
    land(root, "FINE", 2, price_rows(1, 2))  # not reached
    (root / "asset_symbol=FINE" / "page_number=2" / "page.json").write_text("<html>503</html>")
    land(root, "EMPTY", 1, [])
    return cut.read_text()


def test_an_unreadable_page_is_an_error_with_a_reason(spark, tmp_path):
    text = broken_landing(tmp_path / "landing")
    pages = p.read_pages(spark, str(tmp_path / "landing"))
    asked = runs.asset_frame(spark, ["CUT", "SHAPE", "FINE", "EMPTY", "NEW"])
    root = str(tmp_path / "warehouse")
    for _ in range(2):
        status = runs.run_ingest(spark, pages, asked, root, reasons=True)
        assert rows(status) == [
            ("CUT", "error", 0, "page 2 is no JSON"), ("EMPTY", "ingested", 3, None), ("FINE", "ingested", 2, None), ("NEW", "ingested", 3, None),
            ("SHAPE", "error", 0, "page 1 is no page"),
        ]
    paths = runs.table_paths(root)
    assert rows(runs.read_facts(spark, paths["facts"]).select("asset_id").distinct()) == [("EMPTY",), ("FINE",), ("NEW",)]
    held = tables.read_table(spark, paths["quarantine"], schemas.QUARANTINE)
    assert rows(held, "asset_id", "page_number", "problem") == [("CUT", 2, "no JSON"), ("FINE", 2, "no JSON"), ("SHAPE", 1, "no page")]
    assert rows(held.where("asset_id = 'CUT'"), "body") == [(text,)]
    assert held.where("landed_path IS NULL OR landed_at IS NULL").isEmpty()
    log = tables.read_table(spark, paths["ingest_log"], schemas.INGEST_LOG)
    assert rows(log.drop("run_at")) == [(6, 3, 4, 8, 6, 0)] * 2
    asked_for = p.prepare_ingest(pages, asked, fallback_on_failure=True)
    assert dict(rows(asked_for.batch.groupBy("asset_id").count())) == {"CUT": 3, "SHAPE": 3, "FINE": 2, "EMPTY": 3, "NEW": 3}
    none = p.prepare_ingest(pages, asked, fallback=False)
    assert rows(p.ingest_status(asked, none.batch, none.failures), "asset_id", "reason") == [
        ("CUT", "page 2 is no JSON"), ("EMPTY", "no rows"), ("FINE", None), ("NEW", "no rows"), ("SHAPE", "page 1 is no page")]


def test_responses_in_rows_are_read_like_files(spark):
    good = json.dumps({"dataset": {"column_names": HEADER, "data": price_rows(1, 2)}, "next_cursor_id": "c"})
    texts = [("a", 1, good), ("b", 1, good[:-1]), ("c", 1, "[1, 2]"), ("d", 1, ""), ("e", 1, None), ("f", 1, "{}"), (None, 1, good)]
    landed = spark.createDataFrame(texts, "asset_symbol string, page_number int, body string")
    normal = p.normalise_pages(p.parse_pages(landed))
    assert rows(normal.select("asset_id", "problem", F.size("rows"), "next_cursor_id")) == [
        ("A", None, 2, "c"), ("B", "no JSON", 0, None), ("C", "no page", 0, None), ("D", "no JSON", 0, None), ("E", "no JSON", 0, None), ("F", None, 0, None)]
    assert rows(normal.where("problem IS NOT NULL"), "unreadable") == [("",), ("",), ("[1, 2]",), (good[:-1],)]
    assert p.parse_pages(landed.limit(0)).collect() == []
